"""Token ids in binary shard files, reached through a minimal perfect hash.

Documents are range-sorted by key and tokenised; each range becomes one shard of two files. ``ids`` holds the raw
ids of its documents in key order as little-endian unsigned 16 or 32 bits, behind a header and the sorted keys.
``index`` holds a minimal perfect hash of the shard's keys: levels of bit vectors, a key's hash on the first
level where it collided with no other key giving its bit, and the number of bits set before that being its slot. A slot
stores a 32-bit fingerprint of the key, which tells foreign keys apart, and where its documents' ids
lie in the payload. A lookup reads a fixed number of places whatever the shard's size.

The manifest, one row a shard (key range, file names, ids and rows before it), is a table written by Spark. Files are
named by attempt and count only once the manifest names them.

Defined cases: NULL and empty texts are a single end id; rows that repeat a key follow one another and share an
index slot, each keeping its own run of ids; NULL keys come first; an empty table gives an empty result;
only key and text are read. Keys are 64-bit integers.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.llm.elias_fano import pack as pack_file
from tarnworks.llm.elias_fano import unpack as unpack_file
from tarnworks.llm.scratch import Scratch, map_blob, read_table, write_blob
from tarnworks.llm.tokens import Encoder, in_groups

END_ID = 2
TOKENIZER = "word_bpe_49k.json"
SHARD_BYTES = 8 << 20
GAMMA = 2  # bits offered to a key on each level
_NULL_KEY = -(1 << 63)
_TAIL = 64  # so few keys left: they are kept as a list

MANIFEST = (
    "shard bigint, first_key bigint, last_key bigint, ids_file string, index_file string, n_rows bigint, n_ids bigint"
)


def mix(keys: np.ndarray, seed: int) -> np.ndarray:
    """A 64-bit hash of each key (the finaliser of splitmix64)."""
    x = keys.astype(np.int64).view(np.uint64) + np.uint64((seed * 0x9E3779B97F4A7C15) % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def fingerprints(keys: np.ndarray) -> np.ndarray:
    return (mix(keys, 0xF00D) >> np.uint64(32)).astype("<u4")


def build_hash(keys: np.ndarray) -> dict[str, np.ndarray]:
    """Levels of the minimal perfect hash of distinct keys."""
    left, sizes, bits = keys, [], []
    while len(left) > _TAIL:
        size = -(-len(left) * GAMMA // 64) * 64
        at = (mix(left, len(sizes) + 1) % np.uint64(size)).astype(np.int64)
        alone = np.bincount(at, minlength=size) == 1
        sizes.append(size)
        bits.append(np.packbits(alone, bitorder="little").view("<u8"))
        left = left[~alone[at]]
    words = np.concatenate(bits) if bits else np.empty(0, "<u8")
    return {
        "sizes": np.array(sizes, dtype="<i8"), "bits": words, "tail": np.sort(left).astype("<i8"),
        "ranks": np.concatenate([[0], np.cumsum(np.bitwise_count(words), dtype=np.int64)]).astype("<i8"),
    }


def slots_of(keys: np.ndarray, table: dict[str, np.ndarray]) -> np.ndarray:
    """The slot of each key; a foreign key gets any slot, or -1."""
    slot = np.full(len(keys), -1, dtype=np.int64)
    open_, base = np.arange(len(keys)), 0
    for level, size in enumerate(table["sizes"], start=1):
        bit = base + (mix(keys[open_], level) % np.uint64(size)).astype(np.int64)
        word, shift = table["bits"][bit >> 6], (bit & 63).astype(np.uint64)
        hit = ((word >> shift) & np.uint64(1)).astype(bool)
        below = np.bitwise_count(word & ((np.uint64(1) << shift) - np.uint64(1)))
        slot[open_[hit]] = (table["ranks"][bit >> 6] + below)[hit]
        open_, base = open_[~hit], base + int(size)
    at = np.searchsorted(table["tail"], keys[open_])
    inside = at < len(table["tail"])
    inside[inside] = table["tail"][at[inside]] == keys[open_][inside]
    slot[open_[inside]] = table["ranks"][-1] + at[inside]
    return slot


class Shard:
    """Keyed access to one shard through its mapped files."""

    def __init__(self, folder: str, ids_file: str, index_file: str):
        self.payload, _ = unpack_file(map_blob(folder, ids_file))
        self.index, _ = unpack_file(map_blob(folder, index_file))

    @property
    def keys(self) -> np.ndarray:
        return self.payload["keys"]

    def find(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """First row and number of rows of each key; no rows for a key that isn't there."""
        slot = slots_of(keys, self.index)
        known = slot >= 0
        known[known] = self.index["fingerprints"][slot[known]] == fingerprints(keys[known])
        first, count = np.zeros(len(keys), np.int64), np.zeros(len(keys), np.int64)
        first[known] = self.index["first_row"][slot[known]]
        count[known] = self.index["row_count"][slot[known]]
        return first, count

    def bounds(self, row: int) -> tuple[int, int]:
        return int(self.payload["ends"][row - 1]) if row else 0, int(self.payload["ends"][row])

    def ids(self, row: int) -> np.ndarray:
        start, end = self.bounds(row)
        return self.payload["ids"][start:end]


def write_shards(df: DataFrame, scratch: Scratch, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Write the files; returns the manifest (staged), one row a shard."""
    folder = scratch.path("shards")
    rows = df.select(
        F.coalesce(F.col(key).cast("bigint"), F.lit(_NULL_KEY)).alias("id"),
        F.monotonically_increasing_id().alias("copy"),  # spreads the rows of a repeated key over ranges
        F.coalesce(F.col(text), F.lit("")).alias("text"),
    )
    spark = df.sparkSession
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))

    def write(keys: list[int], blocks: list[bytes], shard: int) -> dict:
        ids = np.frombuffer(b"".join(blocks), dtype="<u4")
        ends = np.cumsum([len(b) // 4 for b in blocks], dtype=np.int64)
        narrow = ids.astype("<u2") if not len(ids) or ids.max() < 1 << 16 else ids
        row_keys = np.array(keys, dtype="<i8")
        distinct, first, count = np.unique(row_keys, return_index=True, return_counts=True)
        table = build_hash(distinct)
        slot = slots_of(distinct, table)
        index = {name: np.zeros(len(distinct), kind) for name, kind in (("fingerprints", "<u4"), ("first_row", "<i8"), ("row_count", "<i8"))}
        index["fingerprints"][slot], index["first_row"][slot], index["row_count"][slot] = fingerprints(distinct), first, count
        return {
            "shard": shard, "first_key": keys[0], "last_key": keys[-1],
            "ids_file": write_blob(folder, "ids", pack_file({"keys": row_keys, "ends": ends, "ids": narrow})),
            "index_file": write_blob(folder, "index", pack_file(table | index)),
            "n_rows": len(keys), "n_ids": len(ids),
        }

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        from pyspark import TaskContext

        encoder, end = Encoder(tokenizer_path, keeps_spaces=False), np.array([END_ID], dtype="<u4").tobytes()
        task, number = TaskContext.get().partitionId(), 0
        keys, blocks, size = [], [], 0
        for batch in batches:
            ids, texts = batch["id"].tolist(), batch["text"].tolist()
            for part in in_groups(texts):
                for k, block in zip(ids[part], encoder.ids(texts[part])):
                    keys.append(k)
                    blocks.append(block + end)
                    size += len(block) + 4
                if size >= SHARD_BYTES * 2:  # 32-bit blocks; stored in 16 bits where they fit
                    yield pd.DataFrame([write(keys, blocks, (task << 32) + number)])
                    keys, blocks, size, number = [], [], 0, number + 1
        if keys:
            yield pd.DataFrame([write(keys, blocks, (task << 32) + number)])

    ordered = rows.repartitionByRange(ranges, "id", "copy").sortWithinPartitions("id", "copy")
    return scratch.stage(ordered.mapInPandas(run, MANIFEST), "manifest")


def with_starts(manifest: DataFrame, scratch: Scratch) -> DataFrame:
    """The manifest with the ids and rows before each shard. It has one row for megabytes of ids, so the running
    sum is made over its sorted rows at once."""
    rows = manifest.orderBy("shard").collect()
    starts = np.concatenate([[0], np.cumsum([r["n_ids"] for r in rows], dtype=np.int64)])
    return manifest.sparkSession.createDataFrame(
        [(*r, int(s)) for r, s in zip(rows, starts)], f"{MANIFEST}, start bigint"
    )


def read_back(manifest: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, start, n_tokens, ids_crc32) for every stored document: each key of a shard is looked up in its
    index, and its ids are read where the index says."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            for row in batch.itertuples():
                shard = Shard(folder, row.ids_file, row.index_file)
                distinct = np.unique(shard.keys)
                first, count = shard.find(distinct)
                if (count == 0).any() or count.sum() != row.n_rows:
                    raise ValueError(f"index {row.index_file} doesn't cover its shard")
                rows = np.repeat(first, count) + np.concatenate([np.arange(c) for c in count])
                out = []
                for k, r in zip(np.repeat(distinct, count).tolist(), rows.tolist()):
                    start, end = shard.bounds(r)
                    out.append((None if k == _NULL_KEY else k, row.start + start, end - start, zlib.crc32(shard.ids(r).astype("<u4").tobytes())))
                result = pd.DataFrame(out, columns=[key, "start", "n_tokens", "ids_crc32"])
                result[key] = result[key].astype("Int64")
                yield result

    return manifest.mapInPandas(run, f"`{key}` bigint, start bigint, n_tokens bigint, ids_crc32 bigint")


def lookup(keys: DataFrame, manifest: DataFrame, folder: str, key: str = "doc_id") -> DataFrame:
    """(key, ids) for the stored documents of the given keys, by their shards' indexes.

    Keys are routed by the shards' key ranges (two numbers for megabytes of ids) and meet their shard's files in
    one task, in sorted order."""
    routes = sorted((r["first_key"], r["last_key"], r["ids_file"], r["index_file"]) for r in manifest.select("first_key", "last_key", "ids_file", "index_file").collect())
    firsts, lasts = np.array([r[0] for r in routes]), np.array([r[1] for r in routes])
    ranges = int(keys.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        opened: dict[int, Shard] = {}
        for batch in batches:
            asked = batch["id"].to_numpy(np.int64)
            out = []
            # repeated keys may end one shard and begin the next
            low, high = np.searchsorted(lasts, asked, side="left"), np.searchsorted(firsts, asked, side="right")
            for number in np.unique(np.concatenate([np.arange(a, b) for a, b in {*zip(low.tolist(), high.tolist())}] or [np.empty(0, int)])):
                mine = asked[(low <= number) & (number < high)]
                if number not in opened:
                    opened = {number: Shard(folder, *routes[int(number)][2:])}
                for k, first, count in zip(mine.tolist(), *opened[number].find(mine)):
                    out += [(k, opened[number].ids(r).astype(np.int64).tolist()) for r in range(first, first + count)]
            yield pd.DataFrame(out, columns=[key, "ids"])

    wanted = keys.select(F.col(key).cast("bigint").alias("id")).where("id is not null")
    return wanted.repartitionByRange(ranges, "id").sortWithinPartitions("id").mapInPandas(run, f"`{key}` bigint, ids array<bigint>")


def store(df: DataFrame, tokenizer_path: str, key: str = "doc_id", text: str = "text") -> tuple[DataFrame, str]:
    """Write documents; returns (manifest with starts, folder of the files)."""
    scratch = Scratch(df.sparkSession, "token-store")
    manifest = write_shards(df, scratch, tokenizer_path, key, text)
    return with_starts(manifest, scratch), scratch.path("shards")


def vocabulary_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(TOKENIZER)


def query(spark, sf_dir: str) -> DataFrame:
    manifest, folder = store(read_table(spark, sf_dir, "documents"), vocabulary_path())
    ranges = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return read_back(manifest.repartition(ranges), folder)
