"""Benchmark decontamination: BM25 with a block-max index of the test items.

The items are indexed: for each term its postings (item, impact), where an
impact is the BM25 weight of the term in the item divided by the item's own
score (its BM25 score when the item itself is the query), so that one threshold
holds for all items.  Items are grouped into blocks; for each term and block the
index also holds the largest impact.

Every training text is cut into passages of ``2 * stride`` words that overlap by
half, ``stride`` being the length of the longest item, so that some passage
holds a copied item whole.  Each passage is a query, and all items above the
threshold are retrieved:

* terms of many blocks (function words) are not expanded; the sum of their
  largest impacts bounds what they can add to any item;
* the rarer terms are expanded to their blocks; a block is opened only if its
  block-max sum plus that bound reaches the threshold (the block-max form of
  WAND's pivot test, which loses nothing);
* the postings of opened blocks give exact scores.

A candidate above the threshold is verified on the words around it: the share of
the item's five-word shingles found in the passage, for the whole item and for
its question (all sentences but the last) and answer (the last sentence).  An
item leaks if the whole reaches ``overlap`` and question and answer each
``part_overlap``.

The index is made in Spark (terms, document frequencies over the whole
benchmark) and goes to the tasks in shards of at most ``shard_items`` items; a
larger benchmark takes one pass over the texts per shard.  Texts are never
shuffled and a passage needs no state outside its document.

Edge cases: null, empty and word-less texts and items match nothing; an item of fewer than five words is one
shingle, a question or answer of three to nine words is compared by its words; repeated items each count; equal scores
are all reported; a null doc_id is scored like others; an empty benchmark leaks
nothing.  Only doc_id, text and item_id, text are read.
"""
from __future__ import annotations

import math
import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stride.llm.common import expand_texts, map_texts, mix64, read_table, stored, words_of


@dataclass(frozen=True)
class LeakParams:
    words: int = 5               # words of a shingle
    threshold: float = 0.5       # of the item's own BM25 score
    overlap: float = 0.8         # share of the item's shingles in the passage
    part_overlap: float = 0.5    # the same for question and answer
    short_part: int = 10         # a part of 3 words or more, but fewer than this, is compared by its words, of which
    short_missing: float = 0.25  # this share, rounded up, may be missing (a changed word spoils most of its shingles)
    k1: float = 1.2
    b: float = 0.75
    block: int = 16              # items of a block
    wide: float = 0.25           # terms in more than this share of blocks are not expanded
    shard_items: int = 20000
    min_stride: int = 32


_SENTENCE = re.compile(r"(?<=[.!?\n])\s+")


def split_item(text: str) -> tuple[str, str]:
    """Question and answer: the last sentence answers; a single sentence is cut at two thirds."""
    parts = [s for s in _SENTENCE.split(text.strip()) if s.strip()]
    if len(parts) > 1:
        return " ".join(parts[:-1]), parts[-1]
    words = text.split()
    cut = max(1, (2 * len(words) + 2) // 3)
    return " ".join(words[:cut]), " ".join(words[cut:])


def shingle_hashes(h: np.ndarray, words: int) -> np.ndarray:
    """One hash per run of ``words`` consecutive word hashes (all of them if fewer)."""
    if not len(h):
        return np.zeros(0, np.uint64)
    w = min(words, len(h))
    acc = np.zeros(len(h) - w + 1, np.uint64)
    for j in range(w):
        acc += mix64(h[j:j + len(acc)] + np.uint64((j + 1) * 0xD1B54A32D192ED03 % 2 ** 64))
    return mix64(acc)


def item_terms(batches):
    """mapInPandas: items -> (item_no, n_words, term, tf)."""
    for pdf in batches:
        texts = [t or "" for t in pdf["text"]]
        h, item = words_of(texts)
        for i, no in enumerate(pdf["item_no"]):
            term, tf = np.unique(h[item == i].view(np.int64), return_counts=True)
            if len(term):
                yield pd.DataFrame({"item_no": no, "n_words": int(tf.sum()), "term": term, "tf": tf})


class Shard:
    """Block-max BM25 index of a bounded number of items."""

    def __init__(self, items: pa.Table, postings: pd.DataFrame, n_items: int, mean_words: float, p: LeakParams):
        self.p = p
        items = items.sort_by("item_no")
        self.ids = items.column("item_id").to_pylist()
        number = {no: i for i, no in enumerate(items.column("item_no").to_pylist())}
        self.shingles, self.need, longest = [], [], 1
        for text in items.column("text").to_pylist():
            whole = [words_of([t or ""])[0] for t in (text or "", *split_item(text or ""))]
            longest = max(longest, len(whole[0]))
            short = [i > 0 and 3 <= len(h) < p.short_part for i, h in enumerate(whole)]
            size = [1 if s else min(p.words, len(h)) for s, h in zip(short, whole)]
            self.shingles.append([(w, np.unique(shingle_hashes(h, w))) for w, h in zip(size, whole)])
            self.need.append([p.overlap, *(1 - math.ceil(len(h) * p.short_missing) / len(h) if s else p.part_overlap
                                           for s, h in zip(short[1:], whole[1:]))])
        self.stride = max(p.min_stride, longest)
        postings = postings.sort_values(["term", "item_no"], kind="stable")
        term = postings["term"].to_numpy(np.int64)
        item = np.array([number[x] for x in postings["item_no"]], dtype=np.int64)
        tf, df = postings["tf"].to_numpy(float), postings["df"].to_numpy(float)
        idf = np.log1p((n_items - df + 0.5) / (df + 0.5))
        impact = idf * tf * (p.k1 + 1) / (tf + p.k1 * (1 - p.b + p.b * postings["n_words"].to_numpy(float) / mean_words))
        own = np.bincount(item, weights=impact, minlength=len(items))
        self.impact = (impact / np.maximum(own[item], 1e-12)) if len(item) else impact
        self.vocab, first = np.unique(term, return_index=True)
        self.start = np.append(first, len(term))
        self.item = item
        self.n_blocks = max(1, -(-len(items) // p.block))
        # block-max lists: for each term its blocks and the largest impact in each
        term_no = np.repeat(np.arange(len(self.vocab)), np.diff(self.start))
        key, inverse = np.unique(term_no * self.n_blocks + item // p.block, return_inverse=True)
        most = np.zeros(len(key))
        np.maximum.at(most, inverse, self.impact)
        self.block, self.block_max = key % self.n_blocks, most
        self.block_start = np.searchsorted(key // self.n_blocks, np.arange(len(self.vocab) + 1))
        self.top = np.zeros(len(self.vocab))
        np.maximum.at(self.top, term_no, self.impact)
        self.wide = np.diff(self.block_start) > max(1, p.wide * self.n_blocks)
        self.bits = np.zeros(1 << 20, dtype=bool)  # which low bits some term has
        self.bits[self.vocab & ((1 << 20) - 1)] = True

    def terms(self, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions and term numbers of the words that the index knows."""
        h = h.view(np.int64)
        at = np.flatnonzero(self.bits[h & ((1 << 20) - 1)])
        no = np.searchsorted(self.vocab, h[at])
        known = self.vocab[np.minimum(no, len(self.vocab) - 1)] == h[at]
        return at[known], no[known]

    @staticmethod
    def _expand(start: np.ndarray, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """For each row number, all entries of its list: (which row, entry)."""
        n = start[rows + 1] - start[rows]
        which = np.repeat(np.arange(len(rows)), n)
        offset = np.arange(len(which)) - np.repeat(np.cumsum(n) - n, n)
        return which, start[rows][which] + offset

    def leaks(self, texts: list[str]) -> list[tuple[int, int, float, float, float, float]]:
        """(text, item number, score, overlap, question, answer) of each verified leak, the best passage of each."""
        if not len(self.vocab):
            return []
        p, s = self.p, self.stride
        h, text = words_of(texts)
        if not len(h):
            return []
        n = np.bincount(text, minlength=len(texts))
        first = np.cumsum(n) - n
        windows = np.maximum(1, -(-(n - s) // s))
        windows[n == 0] = 0
        base = np.cumsum(windows) - windows
        at, no = self.terms(h)
        if not len(at):
            return []
        t = text[at]
        w = np.minimum((at - first[t]) // s, windows[t] - 1)
        here = base[t] + w
        before = ((at - first[t]) // s - 1 >= 0) & ((at - first[t]) // s <= windows[t] - 1)
        key = np.unique(np.concatenate([here, here[before] - 1]) * len(self.vocab) + np.concatenate([no, no[before]]))
        window, no = key // len(self.vocab), key % len(self.vocab)
        total = int(windows.sum())
        # pivot test on whole-term maxima, then on block maxima
        alive = np.bincount(window, weights=self.top[no], minlength=total) >= p.threshold
        keep = alive[window]
        window, no = window[keep], no[keep]
        wide = self.wide[no]
        bound = np.bincount(window[wide], weights=self.top[no[wide]], minlength=total)
        which, entry = self._expand(self.block_start, no[~wide])
        cell, inverse = np.unique(window[~wide][which] * self.n_blocks + self.block[entry], return_inverse=True)
        reach = np.bincount(inverse, weights=self.block_max[entry], minlength=len(cell)) + bound[cell // self.n_blocks]
        opened = cell[reach >= p.threshold]
        only_wide = np.flatnonzero(bound >= p.threshold)  # function words alone could do
        if len(only_wide):
            opened = np.union1d(opened, (only_wide[:, None] * self.n_blocks + np.arange(self.n_blocks)).ravel())
        if not len(opened):
            return []
        alive = np.zeros(total, bool)
        alive[opened // self.n_blocks] = True
        keep = alive[window]
        window, no = window[keep], no[keep]
        which, entry = self._expand(self.start, no)
        inside = np.isin(window[which] * self.n_blocks + self.item[entry] // p.block, opened)
        which, entry = which[inside], entry[inside]
        pair, inverse = np.unique(window[which] * len(self.ids) + self.item[entry], return_inverse=True)
        score = np.bincount(inverse, weights=self.impact[entry])
        best: dict[tuple[int, int], tuple] = {}
        for q, sc in zip(pair[score >= p.threshold], score[score >= p.threshold]):
            win, item = int(q // len(self.ids)), int(q % len(self.ids))
            doc = int(np.searchsorted(base, win, side="right") - 1)
            a = first[doc] + (win - base[doc]) * s
            passage = h[a:min(a + 2 * s, first[doc] + n[doc])]
            whole, question, answer = shares = [float(np.isin(x, shingle_hashes(passage, w)).mean()) if len(x) else 1.0
                                                for w, x in self.shingles[item]]
            if all(x >= need - 1e-9 for x, need in zip(shares, self.need[item])):
                row = (whole, float(sc), question, answer)
                if row > best.get((doc, item), ()):
                    best[doc, item] = row
        return [(d, i, r[1], r[0], r[2], r[3]) for (d, i), r in sorted(best.items())]


def shards(benchmark: DataFrame, p: LeakParams):
    """The index shards, one after the other (never all of the benchmark at once)."""
    items = stored(benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text"))
                   .dropDuplicates(["item_id", "text"])
                   .withColumn("item_no", F.xxhash64("item_id", "text")), "leak-items")
    n = items.count()
    if not n:
        return
    terms = items.select("item_no", "text").mapInPandas(item_terms, "item_no long, n_words long, term long, tf long")
    terms = stored(terms, "leak-terms")
    df = terms.groupBy("term").agg(F.count("*").alias("df"))
    postings = stored(terms.join(df, "term"), "leak-postings")
    mean = postings.select("item_no", "n_words").distinct().agg(F.avg("n_words")).first()[0] or 1.0
    pieces = max(1, math.ceil(n / p.shard_items))
    for k in range(pieces):
        part = lambda t: t.where(F.pmod(F.col("item_no"), F.lit(pieces)) == k)
        yield Shard(part(items).toArrow(), part(postings).toPandas(), n, float(mean), p)  # bounded: shard_items


LEAK = "item_id long, score double, overlap double, question_overlap double, answer_overlap double"


def leaks(docs: DataFrame, benchmark: DataFrame, p: LeakParams = LeakParams()) -> DataFrame:
    """One row for each (document, item) pair that is verified."""
    spark = docs.sparkSession
    out = None
    for shard in shards(benchmark, p):
        sent = spark.sparkContext.broadcast(shard)

        def run(texts, sent=sent):
            rows = sent.value.leaks(texts)
            columns = {"item_id": [sent.value.ids[r[1]] for r in rows]}
            for i, name in enumerate(("score", "overlap", "question_overlap", "answer_overlap"), 2):
                columns[name] = [r[i] for r in rows]
            return [r[0] for r in rows], columns

        rows = expand_texts(docs, "doc_id", LEAK, run)
        out = rows if out is None else out.unionByName(rows)
    if out is None:
        return spark.createDataFrame([], f"doc_id long, {LEAK}")
    return out


def op2_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return leaks(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def decontaminate_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no test item leaks into; columns as they came.  Each shard is one map over the texts."""
    for shard in shards(read_table(spark, sf_dir, "benchmark"), LeakParams()):
        sent = spark.sparkContext.broadcast(shard)

        def leaky(texts, sent=sent):
            found = np.zeros(len(texts), bool)
            found[[r[0] for r in sent.value.leaks(texts)]] = True
            return {"__leaky": found}

        docs = map_texts(docs, docs.columns, "__leaky boolean", leaky).where("not __leaky").drop("__leaky")
    return docs
