"""What a task of the trie holds: mapped sequences as they are stored, and a block's texts in runs."""

import tracemalloc

import numpy as np
import pyarrow as pa
import pytest

from tarnworks.llm import ngram_trie
from tarnworks.llm.elias_fano import encode, pack, prefixed, sequence, unpack


def test_reading_a_sequence_holds_nothing_of_its_size():
    values = np.cumsum(np.random.default_rng(1).integers(0, 9, 1_000_000)).astype(np.uint64)
    blob = np.frombuffer(pack(prefixed("s", encode(values, int(values[-1]) + 1))), dtype=np.uint8)
    asked = np.array([0, 17, 500_000, 999_999])
    tracemalloc.start()
    try:
        stored = sequence("s", unpack(blob)[0])
        got, (place, equal) = stored.get(asked), stored.successor(values[asked])
        assert tracemalloc.get_traced_memory()[1] < 100_000
    finally:
        tracemalloc.stop()
    assert (got == values[asked]).all() and equal.all()
    assert (place == np.searchsorted(values, values[asked])).all()


class Here:
    """Coded texts whose pass runs in this process."""

    def __init__(self, batch: pa.RecordBatch):
        self.batch = batch

    @property
    def schema(self):
        from pyspark.sql.types import ArrayType, LongType, StructType

        return StructType().add("ids", ArrayType(LongType()))

    def select(self, *names):
        return self

    def mapInArrow(self, run, schema):
        return list(run(iter([self.batch])))


@pytest.mark.parametrize("lengths", [[200_000] * 12, [1, 2_000_000, 3, 1_000_000, 1_000_000], [1], [5] * 10])
def test_scoring_takes_a_block_in_runs(lengths):
    ends = np.cumsum(lengths)
    token = np.arange(ends[-1]) % 2
    block = ngram_trie._squeezed(np.array([-1, 0]), np.array([0, 3]), token, ends)
    ids = pa.array([list(range(len(ends)))], pa.list_(pa.int64()))
    model = ngram_trie.NgramModel("", [], 64, 3, 1)
    out = ngram_trie.score(Here(pa.RecordBatch.from_arrays([ids, pa.array([block])], ["ids", "block"])), model)
    assert all(b.num_rows == 1 or sum(b.column("n_tokens").to_pylist()) <= 1 << 20 for b in out)
    got = pa.Table.from_batches(out).to_pydict()
    assert got["id"] == list(range(len(ends))) and got["n_tokens"] == lengths
    assert got["n_known"] == [int(x.sum()) for x in np.split(token, ends[:-1])]


@pytest.mark.parametrize("size", [1, 1000])
def test_sorted_counts(size):
    rng = np.random.default_rng(size)
    values, n = rng.integers(0, 50, size), rng.integers(1, 9, size)
    distinct, back, times = np.unique(values, return_inverse=True, return_counts=True)
    for got, want in zip(ngram_trie._sorted_counts(values, n), (distinct, np.bincount(back, weights=n))):
        assert got.tolist() == want.tolist()
    for got, want in zip(ngram_trie._sorted_counts(values.copy()), (distinct, times)):
        assert got.tolist() == want.tolist()
