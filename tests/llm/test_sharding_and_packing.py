"""Jump hashing, token files and packing against brute force, with the awkward rows."""

import zlib
from collections import Counter, defaultdict

import numpy as np
import pandas as pd
import public_tokenizers
import pytest
import xxhash
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tarnworks.llm import jump_shards, packing, token_store

LONG = "word " * 6000
ROWS = [(1, "the cat"), (1, "the cat"), (2, None), (3, ""), (4, "é ü  x\n\n"), (5, LONG), (6, "the cat"), (None, "no key"), (1, "another text"), (-7, "minus")]
SCHEMA = "doc_id long, text string, shard int, start string, `at` int, id int"


def frame(spark, rows=ROWS):
    return spark.createDataFrame([(k, t, 9, "s", 1, 2) for k, t in rows], SCHEMA).repartition(3)


def jump(key: int, shards: int) -> int:
    before, now = -1, 0
    while now < shards:
        before = now
        key = (key * 2862933555777941757 + 1) % 2**64
        now = int((before + 1) * (2.0**31 / ((key >> 33) + 1)))
    return before


@pytest.mark.parametrize("shards", [1, 2, 16, 37])
def test_shards(spark, shards):
    rows = [*ROWS, *((i, f"t{i}") for i in range(100, 400))]
    got = jump_shards.shard_documents(frame(spark, rows), shards).collect()
    assert len(got) == len(rows)
    slots = defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
        if r["doc_id"] is not None:
            key = xxhash.xxh64_intdigest(str(r["doc_id"]), 42)
            assert (r["shard"], r["grown_shard"]) == (jump(key, shards), jump(key, shards + 1))
            assert r["grown_shard"] in (r["shard"], shards)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    want = Counter((k, len((t or "").encode()) + 1, zlib.crc32((t or "").encode()), "key") for k, t in rows)
    assert Counter((r["doc_id"], r["size"], r["text_crc32"], r["law"]) for r in got) == want


def test_empty_tables(spark):
    empty = frame(spark, [])
    assert jump_shards.shard_documents(empty, 4).collect() == []
    assert packing.pack(empty, packing.vocabulary_path()).collect() == []
    manifest, folder = token_store.store(empty, token_store.vocabulary_path())
    assert token_store.read_back(manifest, folder).collect() == []


def encoded(name, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    return lambda text: np.array([*tokenizer.encode(text or "", add_special_tokens=False).ids, end], dtype="<u4")


@pytest.mark.parametrize("shard_bytes", [8 << 20, 64])
def test_token_files(spark, monkeypatch, shard_bytes):
    monkeypatch.setattr(token_store, "SHARD_BYTES", shard_bytes)
    encode = encoded("word_bpe_49k.json", 2)
    manifest, folder = token_store.store(frame(spark), token_store.vocabulary_path())
    got = sorted((tuple(r) for r in token_store.read_back(manifest, folder).collect()), key=lambda r: r[1])
    assert [r[0] for r in got] == sorted([k for k, _ in ROWS], key=lambda k: -99 if k is None else k)
    assert [r[1] for r in got] == [0, *np.cumsum([r[2] for r in got])[:-1]]
    want = Counter((k, len(encode(t)), zlib.crc32(encode(t).tobytes())) for k, t in ROWS)
    assert Counter((k, n, crc) for k, _, n, crc in got) == want
    keys = spark.createDataFrame([(1,), (5,), (77,), (-7,), (None,)], "doc_id long")
    found = token_store.lookup(keys, manifest, folder).collect()
    want = Counter((k, tuple(encode(t).tolist())) for k, t in ROWS if k in (1, 5, -7))
    assert Counter((r["doc_id"], tuple(r["ids"])) for r in found) == want


@settings(max_examples=30, deadline=None)
@given(st.sets(st.integers(-(2**62), 2**62), max_size=600))
def test_perfect_hash(keys):
    keys = np.array(sorted(keys), dtype=np.int64)
    slots = token_store.slots_of(keys, token_store.build_hash(keys))
    assert sorted(slots.tolist()) == list(range(len(keys)))


def best_fit_decreasing(lengths, capacity, rooms=()):
    rooms, before = list(rooms), len(rooms)
    for length in sorted(lengths, reverse=True):
        fitting = [i for i, room in enumerate(rooms) if room >= length]
        if fitting:
            rooms[min(fitting, key=lambda i: rooms[i])] -= length
        else:
            rooms.append(capacity - length)
    return len(rooms) - before


@settings(max_examples=200, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 3), st.integers(0, 3)), max_size=12))
def test_slots_pass_to_later_ranges_by_rank(ranges):
    taken = packing.between_ranges([(i, *r) for i, r in enumerate(ranges)])
    got = {(p, a + i): (q, b + i) for p, a, q, b, n in taken for i in range(n)}
    assert len(set(got.values())) == len(got) == sum(t[4] for t in taken)
    free, want = [], {}
    for part, (slots, missing) in enumerate(ranges):  # the same, one slot at a time
        for rank in range(missing):
            if free:
                want[part, rank] = free.pop()
        free += [(part, rank) for rank in reversed(range(slots))]
    assert got == want and len(taken) <= 2 * len(ranges)


def plain_round(sizes):
    """Pairs of one whole sweep over (size, is_piece), longest first, slots before pieces."""
    free, pairs = [], []
    for size, is_piece in sorted(sizes, key=lambda s: (-s[0], s[1])):
        if not is_piece:
            free.append(size)
        elif free:
            pairs.append((size, free.pop()))
    return sorted(pairs)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 9), st.booleans()), min_size=1, max_size=40), st.integers(1, 7))
def test_sweeps_of_ranges_equal_one_sweep(sizes, per_range):
    rows = sorted(sizes, key=lambda s: (-s[0], s[1]))
    rows = [(i // per_range, is_piece, size, i) for i, (size, is_piece) in enumerate(rows)]
    size_of = {i: size for _, _, size, i in rows}
    swept = []
    for part in sorted({r[0] for r in rows}):
        batch = pd.DataFrame([r for r in rows if r[0] == part], columns=["part", "is_piece", "size", "at"])
        swept += [r for out in packing.sweep(iter([batch.iloc[:2], batch.iloc[2:]])) for r in out.itertuples(index=False)]
    pairs = [(r.size, size_of[r.seq]) for r in swept if r.kind == packing._MATCHED]
    counts = {p: [0, 0, 0] for p in range(rows[-1][0] + 1)}
    for r in swept:
        counts[r.part][r.kind] += 1
    slot = {(r.part, r.rank): size_of[r.seq] for r in swept if r.kind == packing._SLOT}
    piece = {(r.part, r.rank): r.size for r in swept if r.kind == packing._PIECE}
    for p, a, q, b, n in packing.between_ranges([(p, c[packing._SLOT], c[packing._PIECE]) for p, c in counts.items()]):
        pairs += [(piece[p, a + i], slot[q, b + i]) for i in range(n)]
    assert sorted(pairs) == plain_round(sizes)


@settings(max_examples=200, deadline=None)
@given(st.lists(st.integers(1, 30), min_size=1, max_size=60), st.lists(st.integers(1, 29), max_size=20))
def test_a_round_opens_no_more_than_any_packing(lengths, rooms):
    above, more = packing.opening(Counter(lengths), Counter(rooms), 30)
    assert above < max(lengths)
    best, taking = sorted(rooms), [x for x in lengths if x > above]
    needed = best_fit_decreasing(taking, 30, best)
    assert more <= needed and (more or max(rooms) >= max(lengths))


@pytest.mark.parametrize("range_rows", [500_000, 40])
def test_packing(spark, monkeypatch, range_rows):
    monkeypatch.setattr(packing, "RANGE_ROWS", range_rows)
    encode = encoded("byte_bpe_50k.json", 0)
    rows = [*ROWS, *((i, "some words here " * (i % 90)) for i in range(200, 330))]
    got = packing.pack(frame(spark, rows), packing.vocabulary_path(), capacity=256).collect()
    parts, lengths = Counter(), []
    for k, t in rows:
        ids, start = encode(t), 0
        while start < len(ids):
            length = (len(ids) - start) % 256 or 256
            parts[k, start, length, zlib.crc32(ids[start : start + length].tobytes())] += 1
            lengths.append(length)
            start += length
    assert Counter((r["doc_id"], r["start"], r["length"], r["ids_crc32"]) for r in got) == parts
    used = defaultdict(list)
    for r in got:
        used[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in used.values():
        places.sort()
        assert [p[0] for p in places] == [0, *np.cumsum([p[1] for p in places])[:-1]] and sum(p[1] for p in places) <= 256
    assert len(used) == best_fit_decreasing(lengths, 256)
