"""Toxicity: a factorization machine over hashed terms.

Terms (runs of letters and digits, lower-cased) are hashed to ``2**TERM_BITS``
buckets.  From a bounded sample of labelled rows two kinds of terms are chosen, those
that separate the labels best by themselves and those of the pairs whose joint
occurrence does (so a term equally frequent in both classes comes in by its
partner), and a factorization machine

    y = w0 + sum_i w_i x_i + 1/2 sum_f [(sum_i v_if x_i)^2 - sum_i v_if^2 x_i^2]

is fitted on them (x = log(1 + count)), with one more input, the logarithm of
the number of words, which lets the factors weigh a term by the length of the
text.  The products of factors learn pairs of terms, such as an insult beside a
group mention, that additive weights miss.  The model (a few kilobytes) goes to
every task and scores whole texts in Arrow batches: no shuffle, no state.

Edge cases: null and empty texts get the score of a text without terms; rows
with the same doc_id are scored one by one; labels that disagree for a doc_id
count as toxic; a null label or doc_id is not learned from; without any
labelled row of both classes every score is the share of toxic rows (0 without
rows).  Other columns of the inputs are not read.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stride.llm.common import map_texts, mix64, read_table, stored, text_blocks, words_of

TERM_BITS = 18
PAIR_STRIP = 256  # terms whose pairs are counted at once
HASHED_CHARS = 1 << 18  # code points whose words are hashed at once: some 60 bytes each


@dataclass(frozen=True)
class ToxicityParams:
    sample_rows: int = 16384  # bound of the labelled sample, in hash order of doc_id
    terms: int = 512          # hashed terms that the machine sees
    factors: int = 6
    min_rows: int = 5         # sample rows a term occurs in, at least
    least_z: float = 3.0      # standard errors between the classes' shares of a term, at least
    pair_terms: int = 2048    # most frequent terms whose pairs are looked at
    pairs: int = 64           # pairs that bring in their terms, at most
    pair_z: float = 6.0       # standard errors between the classes' shares of a pair, at least
    pair_gain: float = 3.0    # by which it must exceed those of either term alone
    steps: int = 2000         # of the fit, on batches of at most ``batch`` rows
    batch: int = 512
    rate: float = 0.02
    l2: float = 2e-4
    seed: int = 7


@dataclass(frozen=True)
class ToxicityModel:
    slots: np.ndarray    # bucket -> input number, or -1
    linear: np.ndarray   # weights, the length input last
    factors: np.ndarray
    bias: float
    scale: float         # of the length input

    def inputs(self, n_texts: int, bucket: np.ndarray, text: np.ndarray) -> tuple:
        """Sparse inputs: row, column, value of the chosen terms, and the lengths."""
        words = np.bincount(text, minlength=n_texts)
        slot = self.slots[bucket]
        known = slot >= 0
        width = len(self.linear)
        key, count = np.unique(text[known] * width + slot[known], return_counts=True)
        return key // width, key % width, np.log1p(count), np.log1p(words) * self.scale

    def scores(self, texts: list[str]) -> np.ndarray:
        h, text = words_of(texts)
        row, col, x, length = self.inputs(len(texts), (h >> np.uint64(64 - TERM_BITS)).astype(np.int64), text)
        n = len(texts)
        y = self.bias + length * self.linear[-1] + np.bincount(row, weights=self.linear[col] * x, minlength=n)
        for f in range(self.factors.shape[1]):
            v = self.factors[:, f]
            vx = v[col] * x
            own = length * v[-1]
            y += 0.5 * ((np.bincount(row, weights=vx, minlength=n) + own) ** 2
                        - np.bincount(row, weights=vx * vx, minlength=n) - own * own)
        return 1.0 / (1.0 + np.exp(-np.clip(y, -40, 40)))


def term_rows(batches):
    """mapInPandas: (toxic, text) -> (toxic, n_words, buckets, counts)."""
    for pdf in batches:
        texts = [t or "" for t in pdf["text"]]
        labels = pdf["toxic"].tolist()
        for block in text_blocks(texts, HASHED_CHARS):
            part = texts[block]
            h, text = words_of(part)
            bucket = (h >> np.uint64(64 - TERM_BITS)).astype(np.int64)
            key, count = np.unique((text << TERM_BITS) | bucket, return_counts=True)
            cut = np.searchsorted(key >> TERM_BITS, np.arange(len(part) + 1))
            words = np.bincount(text, minlength=len(part))
            yield pd.DataFrame({
                "toxic": labels[block], "n_words": words,
                "buckets": [(key[a:b] & ((1 << TERM_BITS) - 1)).astype(np.int32) for a, b in zip(cut, cut[1:])],
                "counts": [count[a:b].astype(np.int32) for a, b in zip(cut, cut[1:])]})


def train(docs: DataFrame, labels: DataFrame, learn=None, params: ToxicityParams = ToxicityParams()) -> ToxicityModel:
    """Fit on at most ``sample_rows`` labelled rows; ``learn``: which of them may be learned from."""
    rows = labels.select("doc_id", "toxic").where("doc_id is not null and toxic is not null")
    if learn is not None:
        rows = rows.where(learn)
    sample = stored(rows.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
                    .orderBy(F.xxhash64("doc_id"), "doc_id").limit(params.sample_rows), "tox-sample")
    # the sample is bounded by sample_rows: sending it to every task avoids a shuffle of the texts
    terms = stored(docs.select("doc_id", "text").join(F.broadcast(sample), "doc_id")
                   .select("toxic", "text")
                   .mapInPandas(term_rows, "toxic int, n_words long, buckets array<int>, counts array<int>"),
                   "tox-terms")
    n = {r.toxic: r.n for r in terms.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    n0, n1 = sum(v for k, v in n.items() if k < 1), sum(v for k, v in n.items() if k >= 1)
    slots = np.full(1 << TERM_BITS, -1, dtype=np.int32)
    if not n0 or not n1:
        share = min(max(n1 / max(n0 + n1, 1), 1e-6), 1 - 1e-6)
        return ToxicityModel(slots, np.zeros(1), np.zeros((1, params.factors)), float(np.log(share / (1 - share))), 0.1)
    # how far the share of toxic rows with the term lies from that of the others, in standard errors
    pos, neg = F.col("pos"), F.col("all") - F.col("pos")
    share = F.col("all") / F.lit(float(n0 + n1))
    z = (pos / F.lit(float(n1)) - neg / F.lit(float(n0))) / F.sqrt(
        share * (1.0 + 1e-9 - share) * F.lit(1.0 / n0 + 1.0 / n1))
    counted = (terms.select("toxic", F.explode("buckets").alias("bucket"))
               .groupBy("bucket").agg(F.count("*").alias("all"), F.sum((F.col("toxic") >= 1).cast("int")).alias("pos"))
               .where(F.col("all") >= params.min_rows))
    chosen = [r.bucket for r in counted.select("bucket", F.abs(z).alias("z")).where(F.col("z") >= params.least_z)
              .orderBy(F.desc("z"), "bucket").limit(params.terms).collect()]
    frequent = [r.bucket for r in counted.orderBy(F.desc("all"), "bucket").limit(params.pair_terms).collect()]
    chosen += [b for b in paired_terms(terms, frequent, params) if b not in set(chosen)]
    for i, bucket in enumerate(chosen):
        slots[bucket] = i
    width = len(chosen)
    both = F.arrays_zip("buckets", "counts")
    kept = (terms.withColumn("hits", F.filter(both, lambda p: p["buckets"].isin(chosen)))
            .select("toxic", "n_words", "hits.buckets", "hits.counts").toPandas())  # bounded: sample_rows x terms
    x = np.zeros((len(kept), width + 1), dtype=np.float32)
    for i, (b, c) in enumerate(zip(kept["buckets"], kept["counts"])):
        if len(b):
            x[i, slots[np.asarray(b)]] = np.log1p(np.asarray(c))
    x[:, width] = np.log1p(kept["n_words"].to_numpy()) * 0.1
    y = (kept["toxic"].to_numpy() >= 1).astype(np.float32)
    # a fixed order whatever order the rows came in
    order = np.lexsort((mix64(np.ascontiguousarray(x).view(np.uint32).astype(np.uint64).sum(axis=1)), y))
    w0, w, v = fit(x[order], y[order], params)
    return ToxicityModel(slots, w.astype(np.float64), v.astype(np.float64), float(w0), 0.1)


def paired_terms(terms: DataFrame, frequent: list[int], p: ToxicityParams) -> list[int]:
    """Terms of the pairs of ``frequent`` terms whose joint occurrence separates the labels, and
    does so better than either term alone.  Works on the bounded sample."""
    if len(frequent) < 2:
        return []
    known = np.sort(np.array(frequent))

    def pick(batches):
        sets = ([], [])  # of each class, the places in ``known`` of every row's terms
        small = np.min_scalar_type(len(known))
        for pdf in batches:
            for toxic, b in zip(pdf["toxic"], pdf["buckets"]):
                slot = np.minimum(np.searchsorted(known, b), len(known) - 1)
                sets[int(toxic >= 1)].append(slot[known[slot] == b].astype(small))
        n = np.array([float(len(rows)) for rows in sets])

        def differ(both):
            share = both.sum(axis=0) / max(n.sum(), 1)
            return np.abs(both[1] / max(n[1], 1) - both[0] / max(n[0], 1)) / np.sqrt(
                np.maximum(share * (1 - share), 1e-12) * (1 / max(n[0], 1) + 1 / max(n[1], 1)))

        alone = differ(np.stack([np.bincount(np.concatenate([np.zeros(0, small), *rows]), minlength=len(known)).astype(np.float32)
                                 for rows in sets]))
        found = []  # (z, one, two): the best pairs of each strip
        for low in range(0, len(known), PAIR_STRIP):
            strip = slice(low, low + PAIR_STRIP)
            both = np.zeros((2, len(alone[strip]), len(known) - low), np.float32)  # rows of each class with both terms
            for label, rows in enumerate(sets):
                for at in range(0, len(rows), 512):
                    part = rows[at:at + 512]
                    x = np.zeros((len(part), len(known)), np.float32)
                    x[np.repeat(np.arange(len(part)), [len(r) for r in part]), np.concatenate(part)] = 1
                    both[label] += x[:, strip].T @ x[:, low:]
            z = differ(both)
            good = np.triu((both.sum(axis=0) >= p.min_rows) & (z >= p.pair_z)
                           & (z >= np.maximum.outer(alone[strip], alone[low:]) + p.pair_gain), 1)
            one, two = np.nonzero(good)
            best = np.lexsort((two, one, -z[one, two]))[:p.pairs]
            found += zip(-z[one, two][best], one[best] + low, two[best] + low)
        terms_of = dict.fromkeys(int(known[i]) for _, one, two in sorted(found)[:p.pairs] for i in (one, two))
        yield pd.DataFrame({"place": range(len(terms_of)), "bucket": list(terms_of)})

    # one task, over the bounded sample; it holds the counts of PAIR_STRIP * pair_terms pairs at a time
    rows = terms.select("toxic", "buckets").coalesce(1).mapInPandas(pick, "place int, bucket int").collect()  # 2 * pairs at most
    return [r.bucket for r in sorted(rows)]


def fit(x: np.ndarray, y: np.ndarray, p: ToxicityParams) -> tuple[float, np.ndarray, np.ndarray]:
    """Adam on the logistic loss of the machine; weights and factors shrink by ``l2``."""
    rng = np.random.default_rng(p.seed)
    n, d = x.shape
    w0 = np.zeros(1, np.float32) + np.float32(np.log((y.mean() + 1e-3) / (1 - y.mean() + 1e-3)))
    w = np.zeros(d, np.float32)
    v = rng.normal(0, 0.02, (d, p.factors)).astype(np.float32)
    state = [[np.zeros_like(a), np.zeros_like(a)] for a in (w0, w, v)]
    x2, at, order = x * x, n, np.zeros(0, np.int64)
    for step in range(1, p.steps + 1):
        rate = p.rate * 0.5 * (1 + np.cos(np.pi * step / p.steps))
        if at >= n:  # once through all rows
            at, order = 0, rng.permutation(n)
        i = order[at:at + p.batch]
        at += p.batch
        xb = x[i]
        s = xb @ v
        z = w0 + xb @ w + 0.5 * (s * s - x2[i] @ (v * v)).sum(axis=1)
        g = (1 / (1 + np.exp(-np.clip(z, -30, 30))) - y[i]) / len(i)
        gv = xb.T @ (g[:, None] * s) - v * (x2[i].T @ g)[:, None] + p.l2 * v
        grads = (g.sum(keepdims=True), xb.T @ g + p.l2 * w, gv)
        for value, grad, (m, q) in zip((w0, w, v), grads, state):
            m *= 0.9
            m += 0.1 * grad
            q *= 0.999
            q += 0.001 * grad * grad
            value -= rate * (m / (1 - 0.9 ** step)) / (np.sqrt(q / (1 - 0.999 ** step)) + 1e-8)
    return float(w0[0]), w, v


def score(docs: DataFrame, model: ToxicityModel, keep: list[str]) -> DataFrame:
    """Columns ``keep`` of ``docs`` (``text`` need not be one) and ``score`` of the whole text."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # 2**TERM_BITS slots: about a megabyte at any size
    return map_texts(docs, keep, "score double", lambda texts: {"score": sent.value.scores(texts)}, max_chars=HASHED_CHARS)


def fold(column: str = "doc_id"):
    """Remainder of crc32(doc_id as text) by 5: rows of fold 0 are held out."""
    return F.crc32(F.col(column).cast("string").cast("binary")) % 5


def op1_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    model = train(docs, read_table(spark, sf_dir, "labels"), learn=fold() != 0)
    return score(docs, model, ["doc_id"]).select(
        "doc_id", F.coalesce(fold() == 0, F.lit(False)).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


def toxicity_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose score is below 0.5, columns as they came."""
    model = train(docs, read_table(spark, sf_dir, "labels"), learn=fold() != 0)
    named = docs.withColumnsRenamed({c: f"_{c}" for c in docs.columns})  # a column called score may be among them
    kept = score(named.withColumn("text", F.col("_text")), model, named.columns).where(F.col("score") < 0.5)
    return kept.select(*[F.col(f"_{c}").alias(c) for c in docs.columns])
