import random
import tracemalloc
import zlib

import numpy as np
import pandas as pd

from tests.conftest import SF001
from stride.llm.common import words_of
from stride.llm.toxicity import (PAIR_STRIP, TERM_BITS, ToxicityModel, ToxicityParams, fit, op1_toxicity, paired_terms, score,
                                 toxicity_stage, train)


def test_machine_learns_pairs():
    """Toxic only where two terms meet: additive weights can't tell, the factors can."""
    rng = np.random.default_rng(0)
    x = (rng.random((2000, 6)) < 0.4).astype(np.float32)
    y = ((x[:, 0] > 0) & (x[:, 1] > 0)).astype(np.float32)
    w0, w, v = fit(x, y, ToxicityParams())
    s = x @ v
    z = w0 + x @ w + 0.5 * (s * s - (x * x) @ (v * v)).sum(axis=1)
    assert ((z > 0) == (y > 0)).mean() > 0.99 and (v[0] * v[1]).sum() > 0.5


def test_scores_equal_the_sum_over_pairs():
    """The machine's value of a text from its definition: every pair of inputs, one by one."""
    rng = np.random.default_rng(2)
    vocabulary = [f"t{i}" for i in range(12)]
    slots = np.full(1 << TERM_BITS, -1, np.int32)
    for i, w in enumerate(vocabulary[:8]):
        slots[int(words_of([w])[0][0]) >> (64 - TERM_BITS)] = i
    model = ToxicityModel(slots, rng.normal(size=9), rng.normal(size=(9, 3)), 0.3, 0.1)
    texts = [" ".join(rng.choice(vocabulary, rng.integers(0, 30))) for _ in range(40)] + ["", "T3, t3! t3", "t1 " * 50_000]
    for text, got in zip(texts, model.scores(texts)):
        words = text.lower().replace(",", "").replace("!", "").split()
        x = [np.log1p(words.count(w)) for w in vocabulary[:8]] + [0.1 * np.log1p(len(words))]
        y = 0.3 + sum(model.linear[i] * x[i] for i in range(9))
        y += sum(model.factors[i] @ model.factors[j] * x[i] * x[j] for i in range(9) for j in range(i))
        assert abs(got - 1 / (1 + np.exp(-np.clip(y, -40, 40)))) < 1e-9


def test_training_finds_pairs_that_no_term_shows(spark, docs):
    """Toxic where both or neither of two words occur: each word alone is equally frequent in both classes."""
    rnd = random.Random(4)
    rows, labels = [], []
    for i in range(3000):
        a, b = rnd.random() < 0.5, rnd.random() < 0.5
        words = [f"w{rnd.randrange(300)}" for _ in range(25)] + ["alpha"] * a + ["beta"] * b
        rnd.shuffle(words)
        rows.append((i, " ".join(words)))
        labels.append((i, 1, int(a == b)))
    table = spark.createDataFrame(labels, "doc_id long, quality int, toxic int")
    model = train(docs(rows), table, learn="doc_id < 2400")
    out = {r.doc_id: r.score for r in score(docs(rows[2400:]), model, ["doc_id"]).collect()}
    assert sum((out[i] >= 0.5) == bool(t) for i, _, t in labels[2400:]) >= 0.95 * len(out)


class Sample:
    """The sample's rows for ``paired_terms``, its task run in this process."""

    def __init__(self, rows: pd.DataFrame):
        self.rows = rows

    def select(self, *columns):
        return self

    def coalesce(self, n):
        return self

    def mapInPandas(self, fn, schema):
        out = pd.concat(fn(iter([self.rows[:700], self.rows[700:]])))
        self.collected = [type("Row", (tuple,), {"bucket": property(lambda r: r[1])})(r) for r in out.itertuples(index=False)]
        return self

    def collect(self):
        return self.collected


def test_pairs_of_terms_in_strips():
    """Pairs across and within strips as a plain count over all pairs finds them, in its order, without all counts in memory."""
    rng = np.random.default_rng(5)
    width = 2 * PAIR_STRIP + 40
    x = rng.random((1500, width)) < 0.3
    toxic = rng.random(1500) < 0.5
    pairs = [(3, 9), (5, PAIR_STRIP + 7), (PAIR_STRIP + 1, 2 * PAIR_STRIP + 39), (PAIR_STRIP - 1, PAIR_STRIP), (2 * PAIR_STRIP + 1, 2 * PAIR_STRIP + 2)]
    for i, j in pairs:  # both or neither in toxic rows, one of them in the others
        x[:, i] = rng.random(1500) < 0.5
        x[:, j] = np.where(toxic, x[:, i], ~x[:, i])
    known = np.sort(rng.choice(1 << TERM_BITS, width, replace=False))
    sample = Sample(pd.DataFrame({"toxic": toxic.astype(int), "buckets": [known[r].astype(np.int32) for r in x]}))
    got = paired_terms(sample, known[rng.permutation(width)].tolist(), ToxicityParams())
    n1, n0 = toxic.sum(), (~toxic).sum()
    both1, both0 = (x[c].astype(float).T @ x[c].astype(float) for c in (toxic, ~toxic))
    share = (both1 + both0) / 1500
    z = np.abs(both1 / n1 - both0 / n0) / np.sqrt(np.maximum(share * (1 - share), 1e-12) * (1 / n0 + 1 / n1))
    alone = np.diag(z)
    found = sorted((-z[i, j], i, j) for i in range(width) for j in range(i + 1, width)
                   if both1[i, j] + both0[i, j] >= 5 and z[i, j] >= 6 and z[i, j] >= max(alone[i], alone[j]) + 3)
    assert set(pairs) <= {(i, j) for _, i, j in found}
    assert got == list(dict.fromkeys(int(known[k]) for _, i, j in found[:64] for k in (i, j)))

    wide = np.arange(2048)
    sample = Sample(pd.DataFrame({"toxic": [0, 1] * 500, "buckets": [wide[rng.random(2048) < 0.05].astype(np.int32) for _ in range(1000)]}))
    tracemalloc.start()
    paired_terms(sample, wide.tolist(), ToxicityParams())
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert peak < 64e6, peak


def test_edges(spark, docs):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice(["a", "b", "c", "d"]) for _ in range(20)) + (" vile" if i % 3 == 0 else "")) for i in range(60)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i, _ in rows] + [(0, 1, 0), (1, 1, None), (None, 1, 1), (999, 1, 1)],
                                   "doc_id long, quality int, toxic int")
    table = docs(rows + [(100, None), (101, ""), (102, "VILE!"), (102, "VILE!"), (None, "vile " + "a b c d " * 5)])
    model = train(table, labels)
    out = score(table.select("doc_id", "text"), model, ["doc_id"]).collect()
    by = {r.doc_id: r.score for r in out}
    assert len(out) == 65 and by[100] == by[101] < 0.5 < by[3] and by[None] > 0.5 and all(0 <= r.score <= 1 for r in out)
    for none in (labels.where("toxic = 0"), labels.limit(0)):  # no second class: the share of toxic rows
        assert all(r.score < 0.01 for r in score(table.select("doc_id", "text"), train(table, none), ["doc_id"]).collect()) \
            or none.count() == 0
    assert score(table.limit(0), model, ["doc_id"]).collect() == []


def test_stage_drops_toxic_rows(spark, docs, tables):
    rnd = random.Random(1)
    rows = [(i, " ".join(rnd.choice("abcd") for _ in range(20)) + (" vile" if i % 3 == 0 else "")) for i in range(90)]
    labels = spark.createDataFrame([(i, 1, int(i % 3 == 0)) for i, _ in rows], "doc_id long, quality int, toxic int")
    table = docs(rows)
    out = toxicity_stage(spark, table, tables(labels=labels))
    assert out.columns == table.columns and sorted(r.doc_id for r in out.collect()) == [i for i in range(90) if i % 3]


def test_held_out_rows(spark):
    truth = {r.doc_id: r.toxic for r in spark.read.parquet(f"{SF001}/labels.parquet").collect()}
    rows = op1_toxicity(spark, SF001).collect()
    assert len(rows) == spark.read.parquet(f"{SF001}/documents.parquet").count()
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 5 == 0) and r.predicted == (r.score >= 0.5) for r in rows)
    held = [(r.predicted, truth[r.doc_id]) for r in rows if r.held_out and r.doc_id in truth]
    assert sum(p == t for p, t in held) >= 0.95 * len(held)
    assert all(p == 0 or t == 1 for p, t in held)  # clean documents are left alone
