"""The size of a mixed sample: a rare cell doesn't set how much of the others is kept."""

import numpy as np
import pytest

from tarnworks.llm import mixing


def table(spark, stray, copies=1):
    rows = [(i, "w " * (20 + i % 7), f"s{i % 3}", "en" if i % 5 else "de") for i in range(600 * copies)]
    rows += [(10**6, "one stray row of ten words and no more here", None, "en")] * stray
    return spark.createDataFrame(rows, "doc_id long, text string, source string, lang string").repartition(3)


def share(df, **given):
    rows = mixing.with_probability(df, ["source", "lang", "topic"], **given).collect()
    tokens = np.array([r["__tokens"] for r in rows])
    return (tokens * [r["__probability"] for r in rows]).sum() / tokens.sum(), rows


@pytest.mark.parametrize("copies", [1, 10])
def test_a_stray_row_keeps_the_rest(spark, copies):
    whole, _ = share(table(spark, 0, copies))
    assert whole > 0.5
    kept, rows = share(table(spark, 1, copies))
    assert kept == pytest.approx(mixing.RATE, abs=1e-6)
    assert [r["__probability"] for r in rows if r["source"] is None] == [1.0]
    by_source = {s: sum(r["__tokens"] * r["__probability"] for r in rows if r["source"] == s) for s in ("s0", "s1", "s2")}
    own = {s: sum(r["__tokens"] for r in rows if r["source"] == s) ** 0.5 for s in by_source}
    for s in by_source:  # the other sources still stand to one another as their targets do
        assert by_source[s] / sum(by_source.values()) == pytest.approx(own[s] / sum(own.values()), abs=1e-6)
    assert mixing.keep(table(spark, 1, copies)).count() > 0.15 * 600 * copies


@pytest.mark.parametrize("rate", [0.01, 0.4, 0.9, 1.0])
def test_a_given_rate_is_met(spark, rate):
    kept, rows = share(table(spark, 1), rate=rate)
    assert kept == pytest.approx(rate, abs=1e-6) and max(r["__probability"] for r in rows) <= 1


def test_whole_cells_and_their_rest():
    rng = np.random.default_rng(3)
    cells = rng.pareto(0.7, 60) * 10
    members = [np.arange(60) % 5, np.arange(60) // 5 % 4, np.arange(60) // 20]
    targets = [np.full(n, 1 / n) for n in (5, 4, 3)]
    chances, _ = mixing.fill(cells, members, targets, 0.3)
    assert (chances <= 1).all() and (chances > 1e-4).all()
    assert (chances * cells).sum() == pytest.approx(0.3 * cells.sum())
    assert (chances == 1).any()


def test_targets_that_no_sample_meets_are_reported(spark):
    df = spark.createDataFrame([(i, "a b", "s" if i % 2 else "t", "en" if i % 2 else "de") for i in range(40)], "doc_id long, text string, source string, lang string")
    targets = {"source": {"s": 0.9, "t": 0.1}, "lang": {"en": 0.2, "de": 0.8}}
    with pytest.warns(RuntimeWarning, match="settled"):
        rows = mixing.with_probability(df, ["source", "lang"], targets=targets, rate=0.1).collect()
    assert min(r["__probability"] for r in rows) > 0.01
