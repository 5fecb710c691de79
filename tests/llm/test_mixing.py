"""Targets against iterated resharing, tilts against a plain dual solver, copies near their targets."""
import math
import random
import re

import pytest
from pyspark.sql import functions as F

from stride.llm import mixing as X
from stride.llm.registry import QUERIES
from tests.conftest import SF001


def shared(sizes, weights, cap):
    """Targets by sharing, cutting at the cap and sharing the excess again."""
    names = sorted((s for s in sizes if s is not None), key=lambda s: [ord(c) for c in s]) + [None] * (None in sizes)
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    target, open_, left = {}, set(names), float(sum(sizes.values()))
    while open_:
        total = sum(weight[s] for s in open_)
        above = [s for s in open_ if left * weight[s] / total > cap * sizes[s]]
        if not above:
            return target | {s: left * weight[s] / total for s in open_}
        for s in above:
            target[s] = float(cap * sizes[s])
        open_ -= set(above)
        left = sum(sizes.values()) - sum(target.values())
    return target


def tilt(sizes, goal, cap):
    """The multiplier of one source by bisection over documents."""
    mean = sum(sizes) / len(sizes)
    lo, hi = -1000.0, 1000.0
    for _ in range(200):
        mid = (lo + hi) / 2
        taken = sum(n * math.exp(min(mid * n / mean, math.log(cap))) for n in sizes)
        lo, hi = (mid, hi) if taken < goal else (lo, mid)
    return [math.exp(min(hi * n / mean, math.log(cap))) for n in sizes]


def corpus(spark, sizes):
    rows = [(i, None if n is None else " ".join(["wé"] * n), s, 1, 2.0, 3) for i, (s, n) in enumerate(sizes)]
    return spark.createDataFrame(rows, "doc_id long, text string, source string, size long, target double, src int")


def test_mix_against_plain(spark):
    rng = random.Random(5)
    given = [(s, max(1, int(rng.lognormvariate(3, 1)))) for s in ("b", "a", "B", "é", None) for _ in range(60)]
    given += [("small", 2), ("small", 3)] + [("a", 7)] * 400  # a hot cell; a source that meets its cap
    got = X.mix(corpus(spark, given)).collect()
    assert len(got) == len(given)
    sizes = {}
    for s, n in given:
        sizes[s] = sizes.get(s, 0) + n
    want = shared(sizes, (5, 2, 1), 3)
    assert math.isclose(sum(want.values()), sum(sizes.values()))
    for s in sizes:
        mine = [(r, given[r.doc_id]) for r in got if given[r.doc_id][0] == s]
        assert all(r.size == n and r.source_size == sizes[s] for r, (_, n) in mine)
        assert all(math.isclose(r.target, want[s], rel_tol=1e-9) for r, _ in mine)
        rates = tilt([n for _, (_, n) in mine], want[s], 3)
        assert all(math.isclose(r.rate, x, rel_tol=1e-3, abs_tol=1e-3) for (r, _), x in zip(mine, rates))
        assert abs(sum(r.taken for r, _ in mine) - want[s]) <= 2 * min(n for _, (_, n) in mine) + 1
        assert all(r.taken == r.copies * r.size and 0 <= r.copies <= 3 for r, _ in mine)
        cells = {}
        for r, (_, n) in mine:
            cells.setdefault(n, set()).add(r.copies)
        assert all(max(c) - min(c) <= 1 for c in cells.values())  # equal sizes: copies differ by one at most


def test_buckets_do_not_change_the_sums_and_reruns_agree(spark):
    docs = corpus(spark, [("a", 5)] * 500 + [("b", 5)] * 100 + [("b", 11)] * 50)
    runs = [sorted(map(tuple, X.mix(docs, X.MixParams(bucket_rows=b)).collect())) for b in (20, 20, 10 ** 6)]
    assert runs[0] == runs[1]
    assert sum(r[-1] for r in runs[0]) == sum(r[-1] for r in runs[2])


def test_edges(spark, tables):
    none = corpus(spark, []).drop("size")
    assert QUERIES["op12_mix_sources"](spark, tables(documents=none)).count() == 0
    blank = spark.createDataFrame([(1, None, "a"), (1, "", None), (None, " \t\x0b", "a"), (2, " ", "b")], "doc_id long, text string, source string")
    got = sorted(X.mix(blank).collect(), key=lambda r: (r.doc_id is None, r.doc_id, r.size))
    assert [(r.doc_id, r.size, r.taken) for r in got] == [(1, 0, 0), (1, 0, 0), (2, 1, 1), (None, 0, 0)]  # U+00A0 is a word
    nothing = X.mix(blank.where("doc_id = 1")).collect()
    assert len(nothing) == 2 and all(r.target == 0 and r.taken == 0 for r in nothing)


def test_long_text_and_size(spark):
    long_text = "ab\x0c" * 300_000
    got = X.sizes(spark.createDataFrame([(1, long_text, "s"), (2, "a\x1cb c", "s")], "doc_id long, text string, source string")).collect()
    assert [r.size for r in got] == [300_000, len(re.findall(r"[^\x20\x09-\x0D]+", "a\x1cb c"))]


@pytest.mark.parametrize("sizes", [[1] * 9, [1, 100], [5, 5, 5, 80]])
def test_whole_corpus_is_kept_near(spark, sizes):
    got = X.mix(corpus(spark, [("only", n) for n in sizes])).collect()
    assert [r.taken for r in sorted(got)] == sizes  # one source: its target is its size, all rates are one


def test_query_meets_targets(spark):
    rows = QUERIES["op12_mix_sources"](spark, SF001)
    named = rows.join(spark.read.parquet(f"{SF001}/documents.parquet").select("doc_id", "source"), "doc_id")
    for r in named.groupBy("source").agg(F.sum("taken").alias("t"), F.first("target").alias("goal"), F.count("*").alias("n")).collect():
        assert abs(r.t - r.goal) <= 0.01 * r.goal
