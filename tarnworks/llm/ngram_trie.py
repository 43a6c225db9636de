"""Language-model scores from an Elias-Fano n-gram trie.

Tokens are words between ASCII white space with A-Z lower-cased, then one end token, which is also the
context of the first word. The trie is kept in memory-mapped files, one set of shards a level:

* level 1: the words' 64-bit hashes in order (Elias-Fano) and their running counts (Elias-Fano). A word's
  place is its number.
* level k: for each context, which is a place in level k - 1, a range of following words. Pointers to the
  ranges are monotone (Elias-Fano); the words are monotone once counted from their context's base (context
  times vocabulary) and are found by successor search within the context's range; each carries its
  discounted probability in 16 bits (equal steps of the logarithm).

Smoothing is interpolated absolute discounting, p(w|c) = (n(cw) - D) / n(c) + D * T(c) / n(c) * p(w|shorter c),
with T(c), the number of different followers, being the difference of two pointers; the last resort is the
add-half unigram estimate, so unseen words have a probability as well.

Texts are split and their words looked up once; the staged places, a few bytes a token, serve every later pass, in runs of
bounded size (``_runs``). Files are read as they are mapped: a task holds nothing that grows with the trie. Scoring climbs
the trie level by level: a pair's place in one level is the context of the next.

Counting combines in each task before anything is shuffled: level 1 by hash, higher levels as blocks of
sorted, differenced n-grams cut at shard bounds. Bounds come from the exact counts of the contexts and cut
through the followers of a frequent word, so no word, however common, puts its n-grams into one task.

Defined cases: NULL and empty texts are a single end token; a NULL key is never held out; repeated rows
are scored, and learnt from, as often as they stand; an empty table gives an empty result; a training set
without rows gives N = V = 0 and uniform scores; only the key and the text are read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from itertools import chain

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tarnworks.llm.elias_fano import encode, pack, prefixed, sequence, unpack
from tarnworks.llm.scratch import Scratch, map_blob, read_table, write_blob
from tarnworks.llm.stretches import SEPARATOR, cut, listed

ORDER = 3
DISCOUNT = 0.75
FOLD, FOLDS = 1, 5
WORDS_PER_SHARD = 1 << 18
TOKENS_PER_SHARD = 1 << 21
TOKENS_PER_BLOCK = 1 << 21
TOKENS_AT_ONCE = 3 << 18
TOKENS_IN_RUN = 1 << 18
BYTES_AT_ONCE = 4_000_000
KNOWN_WORDS = 300_000
LEVELS_16 = 65535
END = b""


def words_of(text: str | None) -> list[bytes]:
    """The words of one text, without its END; ``_tokens`` gives the same for many."""
    return (text or "").encode("utf-8", "surrogatepass").lower().split()


def word_hash(word: bytes) -> int:
    return xxhash.xxh64_intdigest(word, 0)


def _tokens(texts: pa.Array) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """Distinct tokens of the texts, each token's number among them in order, and where each text's END stands."""
    bodies = [text.lower() for text in listed(texts.fill_null("").cast(pa.large_binary()))]
    words, number, ends = cut(bodies, with_spaces=False)
    return [word if word != SEPARATOR else END for word in listed(words)], number, ends


def _groups(texts: pa.Array) -> Iterator[slice]:
    """Runs of the texts of about so many bytes."""
    start = total = 0
    for i, n in enumerate(pc.fill_null(pc.binary_length(texts), 0).to_pylist()):
        total += n
        if total >= BYTES_AT_ONCE:
            yield slice(start, i + 1)
            start, total = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(key, n) for the words of many texts, counted before they leave the task."""
    place: dict[bytes, int] = {}
    counts = np.zeros(0, dtype=np.int64)

    def flush() -> pa.RecordBatch:
        hashes = np.fromiter(map(word_hash, place), dtype=np.uint64, count=len(place))
        return pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array(counts)], ["key", "n"])

    for batch in batches:
        texts = batch.column("text")
        for part in _groups(texts):
            words, number, _ = _tokens(texts[part])
            at = np.fromiter((place.setdefault(word, len(place)) for word in words), np.int64, len(words))
            counts = np.concatenate([counts, np.zeros(len(place) - len(counts), dtype=np.int64)])
            counts[at] += np.bincount(number, minlength=len(words))
            if len(place) > KNOWN_WORDS:
                yield flush()
                place, counts = {}, np.zeros(0, dtype=np.int64)
    if place:
        yield flush()


def _mass_points(counts: np.ndarray, points: int = 128) -> tuple[list[int], list[int]]:
    """Places and running counts before them, at even steps of the mass; both sides of a heavy entry."""
    running = np.concatenate([[0], np.cumsum(counts)])
    at = np.searchsorted(running, np.linspace(0, running[-1], points, endpoint=False), side="right") - 1
    at = np.unique(np.concatenate([[0], at, at + 1, [len(counts)]]))
    return at.tolist(), running[at].tolist()


def _by_shard(shards: list[dict], places: np.ndarray) -> Iterator[tuple[int, slice]]:
    """Each shard that holds some of the sorted places, and which of them."""
    cuts = np.append(np.searchsorted(places, [s["offset"] for s in shards]), len(places))
    for number in np.flatnonzero(np.diff(cuts)).tolist():
        yield number, slice(cuts[number], cuts[number + 1])


def _pair_cuts(contexts: np.ndarray, words: np.ndarray, bounds: list[tuple[int, int]]) -> np.ndarray:
    """Where the sorted (context, word) pairs reach each bound, and their end."""
    cuts = np.searchsorted(contexts, [b[0] for b in bounds], side="left")
    for i, (context, word) in enumerate(bounds):
        if word:
            run = slice(*np.searchsorted(contexts, [context, context + 1]))
            cuts[i] = run.start + np.searchsorted(words[run], word)
    return np.append(cuts, len(contexts))


class WordLevel:
    """Level 1 over its shards: words to (place, count)."""

    def __init__(self, folder: str, shards: list[dict], shift: int):
        self.folder, self.shards, self.shift, self.open = folder, shards, shift, {}

    def _shard(self, number: int):
        if number not in self.open:
            views, _ = unpack(map_blob(self.folder, self.shards[number]["name"]))
            self.open[number] = sequence("keys", views), sequence("running", views)
        return self.open[number]

    def find(self, hashes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        place = np.full(len(hashes), -1, dtype=np.int64)
        count = np.zeros(len(hashes), dtype=np.int64)
        order = np.argsort(hashes)
        owner = (hashes[order] >> np.uint64(self.shift)).astype(np.int64) if self.shift < 64 else np.zeros(len(hashes), np.int64)
        for number, shard in enumerate(self.shards):
            mine = order[slice(*np.searchsorted(owner, [number, number + 1]))]
            if not len(mine) or not shard["n"]:
                continue
            keys, _ = self._shard(number)
            base = np.uint64(number << self.shift) if self.shift < 64 else np.uint64(0)
            at, known = keys.successor(hashes[mine] - base)
            place[mine[known]] = at[known] + shard["offset"]
            count[mine[known]] = self.counts(at[known] + shard["offset"])
        return place, count

    def counts(self, places: np.ndarray) -> np.ndarray:
        """Counts of sorted places."""
        out = np.zeros(len(places), dtype=np.int64)
        for number, mine in _by_shard(self.shards, places):
            _, running = self._shard(number)
            local = places[mine] - self.shards[number]["offset"]
            out[mine] = (running.get(local + 1) - running.get(local)).astype(np.int64)
        return out


class GramLevel:
    """Level k over its shards. Shard i owns the (context, word) pairs from its bound up to the next one's."""

    def __init__(self, folder: str, shards: list[dict], vocabulary: int):
        self.folder, self.shards, self.vocabulary, self.open = folder, shards, vocabulary, {}
        self.bounds = [tuple(s["bound"]) for s in shards]
        # contexts whose followers lie in several shards: their number of followers, summed over shards
        followers: Counter[int] = Counter()
        for shard in shards:
            for context, n in shard["edges"].items():
                followers[int(context)] += n
        self.split = np.array(sorted(followers), dtype=np.int64)
        self.split_followers = np.array([followers[c] for c in self.split.tolist()], dtype=np.int64)

    def _shard(self, number: int):
        if number not in self.open:
            views, facts = unpack(map_blob(self.folder, self.shards[number]["name"]))
            self.open[number] = (
                sequence("pointers", views), sequence("words", views), views["codes"], facts,
                sequence("running", views) if "running.shape" in views else None,
            )
        return self.open[number]

    def find(self, contexts: np.ndarray, words: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Sorted pairs to (place or -1, discounted probability, number of the context's followers)."""
        place = np.full(len(contexts), -1, dtype=np.int64)
        share = np.zeros(len(contexts))
        followers = np.zeros(len(contexts), dtype=np.int64)
        cuts = _pair_cuts(contexts, words, self.bounds)
        for number in np.flatnonzero(np.diff(cuts)).tolist():
            own = slice(cuts[number], cuts[number + 1])
            pointers, children, codes, facts, _ = self._shard(number)
            inside = np.searchsorted(contexts[own], [facts["first"], facts["first"] + facts["contexts"]]) + own.start
            mine = slice(*inside.tolist())
            local = contexts[mine] - facts["first"]
            if not len(local):
                continue
            new = np.diff(local, prepend=-1) > 0
            distinct, back = local[new], np.cumsum(new) - 1
            ends = pointers.get(np.concatenate([distinct, distinct + 1])).astype(np.int64)
            begin, end = ends[: len(distinct)][back], ends[len(distinct) :][back]
            followers[mine] = end - begin
            base = local.astype(np.uint64) * np.uint64(self.vocabulary)
            at, known = children.successor(base + words[mine].astype(np.uint64))
            known &= (at >= begin) & (at < end)
            place[mine][known] = at[known] + self.shards[number]["offset"]
            share[mine][known] = 10.0 ** (facts["floor"] + codes[at[known]] * facts["step"])
        edge = np.minimum(np.searchsorted(self.split, contexts), len(self.split) - 1)
        at_edge = self.split[edge] == contexts
        followers[at_edge] = self.split_followers[edge[at_edge]]
        return place, share, followers

    def counts(self, places: np.ndarray) -> np.ndarray:
        """Counts of sorted places."""
        out = np.zeros(len(places), dtype=np.int64)
        for number, mine in _by_shard(self.shards, places):
            running = self._shard(number)[4]
            local = places[mine] - self.shards[number]["offset"]
            out[mine] = (running.get(local + 1) - running.get(local)).astype(np.int64)
        return out


class Lookup:
    """Words to (place, count), through a bounded memory of words met before."""

    def __init__(self, level: WordLevel):
        self.level = level
        self._forget()

    def _forget(self) -> None:
        self.known: dict[bytes, int] = {}
        self.place = np.empty(0, dtype=np.int64)
        self.count = np.empty(0, dtype=np.int64)

    def __call__(self, words: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        if len(self.known) > KNOWN_WORDS:
            self._forget()
        new = list(set(words).difference(self.known))
        if new:
            place, count = self.level.find(np.fromiter(map(word_hash, new), np.uint64, len(new)))
            self.known.update(zip(new, range(len(self.known), len(self.known) + len(new))))
            self.place = np.concatenate([self.place, place])
            self.count = np.concatenate([self.count, count])
        index = np.fromiter(map(self.known.__getitem__, words), np.int64, len(words))
        return self.place[index], self.count[index]


def _pair_order(contexts: np.ndarray, words: np.ndarray, vocabulary: int):
    """Distinct pairs in order and each pair's number among them."""
    top = int(contexts.max()) + 1 if len(contexts) else 1
    if top * vocabulary < 1 << 63:
        merged, back = np.unique(contexts * vocabulary + words, return_inverse=True)
        return merged // vocabulary, merged % vocabulary, back
    pairs, back = np.unique(np.stack([contexts, words], axis=1), axis=0, return_inverse=True)
    return pairs[:, 0], pairs[:, 1], back


def _sorted_counts(values: np.ndarray, n: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Distinct values in order and how often each stands, or the sum of its ``n``. Without ``n`` the array itself is sorted."""
    if n is None:
        values.sort()
    else:
        order = np.argsort(values, kind="stable")  # runs in order, which a merging sort is quick with
        values, n = values[order], n[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
    return values[first], np.diff(first, append=len(values)) if n is None else np.add.reduceat(n, first)


def _squeezed(*columns: np.ndarray) -> bytes:
    """Arrays of whole numbers as compressed planes of equal bytes, which shrink far better than whole integers."""
    planes = [np.array([len(columns), *map(len, columns)], dtype="<i8").view(np.uint8)]
    planes += [np.ascontiguousarray(x, dtype="<i8").view(np.uint8).reshape(-1, 8).T.ravel() for x in columns]
    return zstandard.compress(np.concatenate(planes).tobytes(), 1)


def _loosened(block: bytes) -> list[np.ndarray]:
    data = np.frombuffer(zstandard.decompress(block), dtype=np.uint8)
    count = int(data[:8].view("<i8")[0])
    lengths, at, columns = data[8 : 8 * (count + 1)].view("<i8"), 8 * (count + 1), []
    for n in lengths.tolist():
        columns.append(np.ascontiguousarray(data[at : at + 8 * n].reshape(8, -1).T).view("<i8").ravel())
        at += 8 * n
    return columns


class Coded:
    """Texts as the places of their tokens in level 1, and how often each was learnt."""

    def __init__(self, places: np.ndarray, counts: np.ndarray, ends: np.ndarray):
        self.places, self.counts, self.ends = places, counts, ends
        self.starts = np.concatenate([[0], ends[:-1]])

    def before(self, values: np.ndarray, first: int) -> np.ndarray:
        """Each token's predecessor's value, ``first`` for the first token of a text."""
        moved = np.concatenate([[first], values[:-1]])
        moved[self.starts] = first
        return moved


def _runs(block: bytes) -> Iterator[tuple[slice, Coded]]:
    """Which of a block's texts, and these. A run has TOKENS_IN_RUN tokens at most unless it is one text: passes hold some thirty
    numbers a token, so they take a block run by run."""
    distinct, counts, token, ends = _loosened(block)
    first = begin = 0
    while first < len(ends):
        last = max(first + 1, int(np.searchsorted(ends, begin + TOKENS_IN_RUN, side="right")))
        own = token[begin : ends[last - 1]]
        yield slice(first, last), Coded(distinct[own], counts[own], ends[first:last] - begin)
        first, begin = last, int(ends[last - 1])


def code(texts: DataFrame, model: NgramModel) -> DataFrame:
    """(ids, learnt, block) from (id, text, learnt): texts are split and looked up once, all other passes read blocks."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lookup = Lookup(model.word_level())
        held: dict[bool, tuple[list, list, list]] = {True: ([], [], []), False: ([], [], [])}
        size = {True: 0, False: 0}

        def flush(learnt: bool) -> pa.RecordBatch:
            ids, tokens, ends = held[learnt]
            held[learnt], size[learnt] = ([], [], []), 0
            lengths = np.concatenate([np.diff(e, prepend=-1) for e in ends])
            places, back = np.unique(np.concatenate([t[0] for t in tokens]), return_inverse=True)
            counts = np.empty(len(places), dtype=np.int64)
            counts[back] = np.concatenate([t[1] for t in tokens])
            bounds = np.cumsum([0, *(len(t[0]) for t in tokens)])
            token = np.concatenate([back[begin : begin + len(t[0])][t[2]] for begin, t in zip(bounds, tokens)])
            block = _squeezed(places, counts, token, np.cumsum(lengths))
            keys = pa.concat_arrays(ids)
            whole = pa.ListArray.from_arrays(pa.array([0, len(keys)], pa.int32()), keys)
            return pa.RecordBatch.from_arrays([whole, pa.array([learnt]), pa.array([block], pa.binary())], ["ids", "learnt", "block"])

        for batch in batches:
            for learnt in (True, False):
                rows = batch.filter(pc.equal(batch.column("learnt"), learnt))
                for part in _groups(rows.column("text")):
                    ids, tokens, ends = held[learnt]
                    words, number, end = _tokens(rows.column("text")[part])
                    tokens.append((*lookup(words), number))
                    ends.append(end)
                    ids.append(rows.column("id")[part])
                    size[learnt] += len(number)
                    if size[learnt] >= TOKENS_AT_ONCE:
                        yield flush(learnt)
        for learnt in (True, False):
            if held[learnt][0]:
                yield flush(learnt)

    return texts.mapInArrow(run, f"ids array<{texts.schema['id'].dataType.simpleString()}>, learnt boolean, block binary")


class NgramModel:
    """Where a trained trie's files are, and what scoring needs to know about them."""

    def __init__(self, folder: str, words: list[dict], shift: int, tokens: int, vocabulary: int):
        self.folder, self.words, self.shift = folder, words, shift
        self.tokens, self.vocabulary, self.grams = tokens, vocabulary, []

    def word_level(self) -> WordLevel:
        return WordLevel(self.folder, self.words, self.shift)

    def end_place(self) -> int:
        return int(self._end()[0][0])

    def end_count(self) -> int:
        return int(self._end()[1][0])

    def _end(self) -> tuple[np.ndarray, np.ndarray]:
        return self.word_level().find(np.array([word_hash(END)], dtype=np.uint64))

    def gram_levels(self) -> list[GramLevel]:
        return [GramLevel(self.folder, shards, self.vocabulary) for shards in self.grams]


def _offsets(rows: list[dict]) -> list[dict]:
    total = 0
    for row in rows:
        row["offset"] = total
        total += row["n"]
    return rows


def _train_words(texts: DataFrame, scratch: Scratch) -> NgramModel:
    counts = scratch.stage(
        texts.select("text").mapInArrow(_counted, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n")), "words"
    )
    total = counts.agg(F.count("*").alias("v"), F.coalesce(F.sum("n"), F.lit(0)).alias("t")).first()
    bits = max(0, (-(-total["v"] // WORDS_PER_SHARD) - 1).bit_length())
    shift, folder = 64 - bits, scratch.path("trie")

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        keys = rows["key"].to_numpy(np.int64).view(np.uint64)
        order = np.argsort(keys)
        keys, n = keys[order], rows["n"].to_numpy(np.int64)[order]
        number = int(keys[0] >> np.uint64(shift)) if shift < 64 else 0
        base = np.uint64(number << shift) if shift < 64 else np.uint64(0)
        running = np.concatenate([[0], np.cumsum(n)])
        blob = pack(prefixed("keys", encode(keys - base, 1 << shift)) | prefixed("running", encode(running, int(running[-1]) + 1)))
        at, mass = _mass_points(n)
        return pd.DataFrame({"shard": [number], "name": [write_blob(folder, "words", blob)], "n": [len(n)], "at": [at], "mass": [mass]})

    shard = F.shiftrightunsigned("key", shift) if bits else F.lit(0).cast("bigint")
    built = scratch.stage(
        counts.withColumn("shard", shard).groupBy("shard")
        .applyInPandas(build, "shard bigint, name string, n bigint, at array<bigint>, mass array<bigint>"),
        "word-shards",
    )
    rows = {r["shard"]: r.asDict() for r in built.collect()}  # one row a shard
    empty = {"name": None, "n": 0, "at": [], "mass": []}
    return NgramModel(folder, _offsets([rows.get(i, dict(empty)) for i in range(1 << bits)]), shift, total["t"], total["v"])


def _mass_curve(shards: list[dict]) -> tuple[np.ndarray, np.ndarray]:
    places, masses, total = [0], [0], 0
    for shard in shards:
        places += [shard["offset"] + a for a in shard["at"]]
        masses += [total + m for m in shard["mass"]]
        total = masses[-1]
    return np.array(places), np.array(masses)


def _bounds(model: NgramModel) -> list[tuple[int, int]]:
    """First (context, word) of each shard of the next level, at even steps of the contexts' exact counts."""
    places, masses = _mass_curve(model.grams[-1] if model.grams else model.words)
    words, word_masses = _mass_curve(model.words)
    shards = max(1, -(-int(masses[-1]) // TOKENS_PER_SHARD))
    bounds = [(0, 0)]
    for mass in np.linspace(0, masses[-1], shards, endpoint=False)[1:]:
        at = int(np.searchsorted(masses, mass, side="right"))
        span, part = places[at] - places[at - 1], (mass - masses[at - 1]) / max(1, masses[at] - masses[at - 1])
        context, word = int(places[at - 1] + int(span * part)), 0
        if span == 1:  # inside one context: cut among its followers, as words are distributed overall
            word = int(np.interp(part * word_masses[-1], word_masses, words))
        if (context, word) > bounds[-1]:
            bounds.append((context, word))
    return bounds


def _train_level(coded: DataFrame, model: NgramModel, end_place: int, keep_counts: bool, scratch: Scratch) -> None:
    bounds, folder, level = _bounds(model), model.folder, len(model.grams) + 2

    contexts = sum(shard["n"] for shard in (model.grams[-1] if model.grams else model.words))
    wide = contexts * model.vocabulary >= 1 << 63  # else a pair is one number

    def gather(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        levels = model.gram_levels()
        held: list[np.ndarray] = []

        def flush() -> pd.DataFrame:
            pairs = np.concatenate(held, axis=-1)
            held.clear()
            if wide:
                (c, w), n = np.unique(pairs, axis=1, return_counts=True)
            else:
                pairs, n = _sorted_counts(pairs)
                c, w = np.divmod(pairs, model.vocabulary)
            cuts = _pair_cuts(c, w, bounds)
            rows = []
            for i in np.flatnonzero(np.diff(cuts)):
                part = slice(cuts[i], cuts[i + 1])
                rows.append((int(i), _squeezed(np.diff(c[part], prepend=0), w[part], n[part])))
            return pd.DataFrame(rows, columns=["shard", "block"])

        for batch in batches:
            for _, texts in chain.from_iterable(map(_runs, batch["block"])):
                context = texts.before(texts.places, end_place)
                for level_below in levels:  # a place in the level below is the next token's context
                    longer = np.full(len(context), -1, dtype=np.int64)
                    usable = np.flatnonzero(context >= 0)
                    c, w, back = _pair_order(context[usable], texts.places[usable], model.vocabulary)
                    longer[usable] = level_below.find(c, w)[0][back]
                    context = texts.before(longer, -1)
                usable = context >= 0
                c, w = context[usable], texts.places[usable]
                held.append(np.stack([c, w]) if wide else c * model.vocabulary + w)
                if sum(h.shape[-1] for h in held) >= TOKENS_PER_BLOCK:
                    yield flush()
        if held:
            yield flush()

    def build(rows: pd.DataFrame) -> pd.DataFrame:
        number = int(rows["shard"].iloc[0])
        parts = [_loosened(block) for block in rows["block"]]
        first = min(int(p[0][0]) for p in parts)
        top = (max(int(p[0].sum()) for p in parts) - first + 1) * model.vocabulary
        if top >= 1 << 63:
            raise OverflowError("a shard's contexts times the vocabulary must stay below 2^63; use smaller shards")
        pairs = np.concatenate([(np.cumsum(p[0]) - first) * model.vocabulary + p[1] for p in parts])
        n = np.concatenate([p[2] for p in parts])
        del parts
        merged, n = _sorted_counts(pairs, n)
        del pairs
        local = merged // model.vocabulary
        contexts = int(local[-1]) + 1
        pointers = np.searchsorted(local, np.arange(contexts + 1))
        distinct, of = np.unique(local, return_inverse=True)
        below = model.gram_levels()[-1] if model.grams else model.word_level()
        share = np.log10((n - DISCOUNT) / below.counts(distinct + first)[of])
        floor = float(share.min())
        step = max((float(share.max()) - floor) / LEVELS_16, 1e-12)
        arrays = (
            prefixed("pointers", encode(pointers, len(merged) + 1)) | prefixed("words", encode(merged, top))
            | {"codes": np.round((share - floor) / step).astype("<u2")}
        )
        if keep_counts:
            running = np.concatenate([[0], np.cumsum(n)])
            arrays |= prefixed("running", encode(running, int(running[-1]) + 1))
        blob = pack(arrays, first=first, contexts=contexts, floor=floor, step=step)
        at, mass = _mass_points(n)
        edges = {str(first + i): int(pointers[i + 1] - pointers[i]) for i in {0, contexts - 1}}
        return pd.DataFrame({
            "shard": [number], "name": [write_blob(folder, f"grams{level}", blob)], "n": [len(merged)],
            "at": [at], "mass": [mass], "edges": [edges],
        })

    built = scratch.stage(
        coded.select("block").mapInPandas(gather, "shard bigint, block binary").groupBy("shard").applyInPandas(
            build, "shard bigint, name string, n bigint, at array<bigint>, mass array<bigint>, edges map<string,bigint>"
        ),
        f"gram-shards-{level}",
    )
    rows = [r.asDict() | {"bound": bounds[r["shard"]]} for r in built.orderBy("shard").collect()]  # one row a shard
    model.grams.append(_offsets(rows))


def train(texts: DataFrame, scratch: Scratch, order: int = ORDER) -> tuple[NgramModel, DataFrame]:
    """texts: (id, text, learnt). Learns from the rows marked so. Returns the model and all rows coded for it, for ``score``;
    the files of both stay in the scratch folder."""
    model = _train_words(texts.where("learnt"), scratch)
    coded = scratch.stage(code(texts, model), "coded")
    if model.tokens:
        end_place = model.end_place()
        for level in range(2, order + 1):
            _train_level(coded.where("learnt"), model, end_place, level < order, scratch)
    return model, coded


def score(coded: DataFrame, model: NgramModel) -> DataFrame:
    """(id, n_tokens, n_known, base_score, score) for every coded text."""
    total = model.tokens + 0.5 * (model.vocabulary + 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        levels = model.gram_levels()
        end_place, end_count = (model.end_place(), model.end_count()) if levels else (-1, 0)
        for batch in batches:
            for at in range(batch.num_rows):
                ids = batch.column("ids")[at].values
                for own, texts in _runs(batch.column("block")[at].as_py()):
                    base = (texts.counts + 0.5) / total
                    chance = base.copy()
                    context, context_counts = texts.before(texts.places, end_place), texts.before(texts.counts, end_count)
                    for depth, level in enumerate(levels):
                        usable = np.flatnonzero(context >= 0)
                        if not len(usable):
                            break
                        known = texts.places[usable] >= 0
                        c, w, back = _pair_order(context[usable], np.where(known, texts.places[usable], 0), model.vocabulary)
                        place, share, followers = level.find(c, w)
                        if depth:
                            new = np.flatnonzero(np.diff(c, prepend=-1))  # the first pair of each context
                            times = levels[depth - 1].counts(c[new])[np.cumsum(np.diff(c, prepend=-1) > 0) - 1][back]
                        else:
                            times = context_counts[usable]
                        weight = DISCOUNT * followers[back] / np.maximum(times, 1)
                        mixed = np.where(known, share[back], 0.0) + weight * chance[usable]
                        chance[usable] = np.where(followers[back] > 0, mixed, chance[usable])
                        longer = np.full(len(context), -1, dtype=np.int64)
                        longer[usable] = np.where(known, place[back], -1)
                        context = texts.before(longer, -1)
                    yield pa.RecordBatch.from_arrays([
                        ids[own], pa.array(texts.ends - texts.starts, pa.int64()),
                        pa.array(np.add.reduceat((texts.counts > 0).astype(np.int64), texts.starts)),
                        pa.array(np.add.reduceat(np.log10(base), texts.starts)), pa.array(np.add.reduceat(np.log10(chance), texts.starts)),
                    ], ["id", "n_tokens", "n_known", "base_score", "score"])

    kind = coded.schema["ids"].dataType.elementType.simpleString()
    return coded.select("ids", "block").mapInArrow(run, f"id {kind}, n_tokens bigint, n_known bigint, base_score double, score double")


def held_out_scores(df: DataFrame, key: str = "doc_id", text: str = "text", order: int = ORDER) -> DataFrame:
    """Learn from the rows whose fold isn't FOLD, score all of them."""
    def held_out(id_: str):
        return F.coalesce(F.pmod(F.crc32(F.col(id_).cast("string")), F.lit(FOLDS)) == FOLD, F.lit(False))

    rows = df.select(F.col(key).alias("id"), F.col(text).alias("text"), (~held_out(key)).alias("learnt"))
    model, coded = train(rows, Scratch(df.sparkSession, "ngram-trie"), order)
    return score(coded, model).select(
        F.col("id").alias(key), held_out("id").alias("held_out"),
        "n_tokens", "n_known", F.lit(model.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )


def query(spark, sf_dir: str) -> DataFrame:
    return held_out_scores(read_table(spark, sf_dir, "documents"))
