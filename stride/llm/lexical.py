"""Ranked lexical search: MaxScore with bounds on pairs of terms.

The items of a benchmark are the queries; every document is ranked for each.  A
term's impact in a document is an integer, so scores are exact and equal scores are
real ties.

1. *Postings.*  One map over the whole texts keeps, of each document, its length and
   the frequencies of the terms that some item has.  Numbers over all documents
   (how many, their length, how many hold a term) are partial aggregates.
2. *Index.*  Documents are indexed in blocks: for each term the documents of the block
   with their weighted impacts, and for each pair of terms the intersection of their
   lists with the largest impact that any of its documents has for both together.  The
   pairs are near neighbours in an item's order of weights.  The index is a written
   table, a row for each block.
3. *Search.*  A document that holds both terms of a pair scores at most the pair's
   joint maximum for them, one that holds a single term at most that term's maximum; the larger
   of these is the pair's bound, lower than the sum of both maxima by what the pair
   saves.  For each item and block the terms are taken by rising maximum, each put
   together with the free term before it whose pair saves most; the running sums of
   these bounds are lower than those of the maxima alone.  Terms whose sum stays below
   the item's 10th best score cannot bring in a document: only the lists of the
   others are walked for candidates.  Candidates then go through the rest, largest
   first, and are dropped as soon as score and remaining sum fall below the 10th best; a
   block whose whole sum does is passed over.  The best scores go from block to block in a task.
4. *Merge.*  Each task emits its best ten of each item; the best of all follow from a
   window limited before its shuffle.

Items are taken in shards of a bounded number; the vocabulary of a shard (64-bit
hashes of its terms) and its pairs are all that is broadcast.

Edge cases: null texts have no terms; a document or item without terms takes no part;
rows that repeat an item_id are one item with the terms of all; rows that repeat a
doc_id are documents of their own; equal scores go by ascending doc_id, null ids last;
a term that weighs nothing adds nothing; empty tables give an empty result; other columns
are never read.
"""
from __future__ import annotations

import math
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stride.llm.common import codes_of, expand_texts, lower_ascii, map_texts, read_table, run_hashes, runs, stored

NO_ID = np.iinfo(np.int64).max  # stands for a null doc_id inside a task


@dataclass(frozen=True)
class SearchParams:
    top: int = 10
    block_docs: int = 2048
    shard_items: int = 20_000
    partners: int = 4         # following terms, by weight, that a term of an item makes pairs with


def term_hashes(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each term: runs of ASCII letters and digits and of all code points from 128, A-Z lower-cased."""
    codes, starts = codes_of(texts)
    codes = lower_ascii(codes)
    begin, end = runs((codes >= 128) | ((codes >= 48) & (codes <= 57)) | ((codes >= 97) & (codes <= 122)))
    return run_hashes(codes, begin, end).view(np.int64), np.searchsorted(starts, begin, side="right") - 1


class Queries:
    """The items of a shard over their common vocabulary."""

    def __init__(self, ids: list, item: np.ndarray, term: np.ndarray):
        self.ids = ids
        self.vocabulary, number = np.unique(term, return_inverse=True)
        order = np.lexsort((number, item))
        self.term = number[order]
        self.start = np.searchsorted(item[order], np.arange(len(ids) + 1))

    def weigh(self, df: np.ndarray, n_docs: int, n_terms: int, partners: int = SearchParams.partners) -> None:
        """Weights, and the pairs of near neighbours in each item's order of weights."""
        self.n_docs, self.n_terms = n_docs, n_terms
        self.weight = np.array([math.floor(1000 * math.log((2 * n_docs + 2) / (2 * d + 1))) for d in df.tolist()], np.int64)
        both, self.terms, size = [], [], len(self.vocabulary)
        for a, b in zip(self.start, self.start[1:]):
            t = self.term[a:b]
            t = t[np.lexsort((t, self.weight[t]))]
            near = [np.stack([t[:-k], t[k:]]) for k in range(1, min(partners, len(t) - 1) + 1)]
            low, high = np.sort(np.concatenate(near, axis=1), axis=0) if near else np.zeros((2, 0), np.int64)
            self.terms.append(t)
            both.append(low * size + high)
        keys = np.concatenate(both) if both else np.zeros(0, np.int64)
        pairs, number = np.unique(keys, return_inverse=True)
        self.first, self.second = pairs // max(size, 1), pairs % max(size, 1)
        edge = np.cumsum([0, *map(len, both)])
        self.pairs = [number[a:b] for a, b in zip(edge, edge[1:])]


def item_shards(benchmark: DataFrame, p: SearchParams):
    """The queries in shards of a bounded number of items."""
    items = benchmark.select("item_id", F.coalesce("text", F.lit("")).alias("text")).withColumn("key", F.xxhash64("item_id"))
    made = expand_texts(items.withColumn("who", F.struct("item_id", "key")), "who", "term long",
                        lambda texts: (lambda h, t: (t, {"term": h}))(*term_hashes(texts)))
    terms = stored(made.select("who.item_id", "who.key", "term").distinct(), "search-terms")
    pieces = math.ceil(terms.select("key").distinct().count() / p.shard_items)
    for k in range(pieces):
        rows = terms.where(F.pmod("key", F.lit(pieces)) == k).toArrow()  # bounded: about shard_items items
        ids, item = np.unique(rows.column("key").to_numpy(), return_inverse=True)
        known = dict(zip(rows.column("key").to_pylist(), rows.column("item_id").to_pylist()))
        yield Queries([known[i] for i in ids.tolist()], item, rows.column("term").to_numpy())


def postings(docs: DataFrame, queries) -> DataFrame:
    """(doc_id, n, terms, tfs): length of each document that has terms, and its frequencies of the queries' terms."""

    def count(texts):
        vocabulary = queries.value.vocabulary
        h, text = term_hashes(texts)
        no = np.minimum(np.searchsorted(vocabulary, h), len(vocabulary) - 1)
        known = vocabulary[no] == h
        key, tf = np.unique(text[known] * len(vocabulary) + no[known], return_counts=True)
        edge = np.searchsorted(key // len(vocabulary), np.arange(1, len(texts)))
        return {"n": np.bincount(text, minlength=len(texts)), "terms": np.split(key % len(vocabulary), edge)[:len(texts)],
                "tfs": np.split(tf, edge)[:len(texts)]}

    return map_texts(docs, ["doc_id"], "n long, terms array<int>, tfs array<int>", count).where("n > 0")


INDEX = ("docs array<long>, term array<int>, start array<int>, doc array<int>, impact array<long>, most array<long>, "
         "pair array<int>, joint array<long>")


def index(listed: DataFrame, queries) -> DataFrame:
    """A row for each block of documents: the lists of its terms (``term[i]`` owns
    ``doc`` and ``impact`` from ``start[i]`` to ``start[i + 1]``, ``most[i]`` is its
    largest impact), and the pairs that some document holds with their joint maxima."""
    p = SearchParams()

    def build(batches):
        q = queries.value
        for batch in batches:
            for at in range(0, batch.num_rows, p.block_docs):
                yield pa.RecordBatch.from_pydict(_block(batch.slice(at, p.block_docs), q))

    return listed.select("doc_id", "n", "terms", "tfs").mapInArrow(build, INDEX)


def _block(rows: pa.RecordBatch, q: Queries) -> dict:
    ids = rows.column(0).fill_null(NO_ID).to_numpy()
    n = rows.column(1).to_numpy()
    size = np.diff(rows.column(2).offsets.to_numpy())
    doc = np.repeat(np.arange(len(ids)), size)
    term = rows.column(2).flatten().to_numpy().astype(np.int64)
    tf = rows.column(3).flatten().to_numpy().astype(np.int64)
    m = 10 + (90 * n * q.n_docs) // q.n_terms
    impact = q.weight[term] * ((1_000_000_000 * tf) // (1000 * tf + 8 * m[doc]))
    order = np.lexsort((doc, term))
    term, doc, impact = term[order], doc[order], impact[order]
    terms, start = np.unique(term, return_index=True)
    start = np.append(start, len(term)).astype(np.int64)
    most = np.maximum.reduceat(impact, start[:-1]) if len(terms) else np.zeros(0, np.int64)
    # intersections: the postings of each pair's first term looked up among those of its second
    place = np.full(len(q.vocabulary), -1)
    place[terms] = np.arange(len(terms))
    pair = np.flatnonzero((place[q.first] >= 0) & (place[q.second] >= 0))
    a, b = place[q.first[pair]], place[q.second[pair]]
    a, b = np.where(start[a + 1] - start[a] <= start[b + 1] - start[b], [a, b], [b, a])
    length = start[a + 1] - start[a]
    which = np.repeat(np.arange(len(pair)), length)
    entry = start[a][which] + np.arange(len(which)) - np.repeat(np.cumsum(length) - length, length)
    key = term * len(ids) + doc
    wanted = terms[b][which] * len(ids) + doc[entry]
    other = np.minimum(np.searchsorted(key, wanted), max(len(key) - 1, 0))
    common = key[other] == wanted if len(wanted) else np.zeros(0, bool)
    joint = np.zeros(len(pair), np.int64)
    np.maximum.at(joint, which[common], impact[entry[common]] + impact[other[common]])
    meet = joint > 0
    column = lambda x, t: pa.array([x], pa.list_(t))
    return {"docs": column(ids, pa.int64()), "term": column(terms, pa.int32()), "start": column(start, pa.int32()),
            "doc": column(doc, pa.int32()), "impact": column(impact, pa.int64()), "most": column(most, pa.int64()),
            "pair": column(pair[meet], pa.int32()), "joint": column(joint[meet], pa.int64())}


class Best:
    """The best scores of each item so far."""

    def __init__(self, n_items: int, top: int):
        self.top = top
        self.score = [np.zeros(0, np.int64)] * n_items
        self.doc = [np.zeros(0, np.int64)] * n_items

    def least(self, item: int) -> int:
        """Scores below this cannot enter."""
        s = self.score[item]
        return int(s[-1]) if len(s) == self.top else 1

    def add(self, item: int, score: np.ndarray, doc: np.ndarray) -> None:
        s, d = np.concatenate([self.score[item], score]), np.concatenate([self.doc[item], doc])
        order = np.lexsort((d, -s))[:self.top]
        self.score[item], self.doc[item] = s[order], d[order]


def bounds(terms: np.ndarray, most: np.ndarray, pairs: np.ndarray, first: np.ndarray, second: np.ndarray,
           bound: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """An item's terms by rising maximum, and for each how much it and all before it can score together."""
    order = terms[np.lexsort((terms, most[terms]))]
    order = order[most[order] > 0]  # terms that the block has
    added = most[order]
    if len(pairs):
        rank = dict(zip(order.tolist(), range(len(order))))
        saved = most[first[pairs]] + most[second[pairs]] - bound[pairs]
        pairs, saved = pairs[saved > 0], saved[saved > 0]
        free = [True] * len(order)
        met = sorted((max(rank[a], rank[b]), -s, min(rank[a], rank[b])) for a, b, s in zip(
            first[pairs].tolist(), second[pairs].tolist(), saved.tolist()))
        for later, gain, earlier in met:
            if free[later] and free[earlier]:
                free[later] = free[earlier] = False
                added[later] += gain
    return order, np.cumsum(added)


def search_block(block: dict, q: Queries, best: Best, pair_bounds: bool = True) -> int:
    """Raise ``best`` by the documents of a block; returns how many postings were walked for candidates."""
    ids, term, start, doc, impact = (block[c] for c in ("docs", "term", "start", "doc", "impact"))
    place = np.full(len(q.vocabulary), -1)
    place[term] = np.arange(len(term))
    most = np.append(block["most"], 0)[place]  # by term; 0: the block does not have it
    joint = np.zeros(len(q.first), np.int64)
    joint[block["pair"]] = block["joint"]
    bound = np.maximum(np.maximum(most[q.first], most[q.second]), joint)
    read = 0
    total = np.zeros(len(ids), np.int64)
    for item, (terms, pairs) in enumerate(zip(q.terms, q.pairs)):
        least = best.least(item)
        if not len(terms) or most[terms].sum() < least:
            continue
        order, reach = bounds(terms, most, pairs if pair_bounds else pairs[:0], q.first, q.second, bound)
        if not len(order) or reach[-1] < least:
            continue
        cut = int(np.searchsorted(reach, least))  # terms before it add up to less
        touched = []
        for t in order[cut:].tolist():
            lo, hi = start[place[t]], start[place[t] + 1]
            total[doc[lo:hi]] += impact[lo:hi]
            touched.append(doc[lo:hi])
            read += int(hi - lo)
        found = np.unique(np.concatenate(touched))
        score = total[found]
        total[found] = 0
        if len(score) > best.top:
            least = max(least, int(np.partition(score, len(score) - best.top)[len(score) - best.top]))
        for j in range(cut - 1, -1, -1):
            alive = score + reach[j] >= least
            found, score = found[alive], score[alive]
            if not len(found):
                break
            lo, hi = start[place[order[j]]], start[place[order[j]] + 1]
            at = np.minimum(np.searchsorted(doc[lo:hi], found), hi - lo - 1)
            score = score + np.where(doc[lo:hi][at] == found, impact[lo:hi][at], 0)
        good = (score >= least) & (score > 0)
        if good.any():
            best.add(item, score[good], ids[found[good]])
    return read


def ranked(docs: DataFrame, benchmark: DataFrame, p: SearchParams = SearchParams()) -> DataFrame:
    """(item_id, rank, doc_id, score): the ``top`` documents of each item."""
    spark = docs.sparkSession
    out = spark.createDataFrame([], "item_id long, doc_id long, score long")
    for number, queries in enumerate(item_shards(benchmark, p)):
        sent = spark.sparkContext.broadcast(queries)
        listed = stored(postings(docs, sent), f"search-postings-{number}")
        n_docs, n_terms = listed.agg(F.count("*"), F.sum("n")).first()
        if not n_docs:
            continue
        held = listed.select(F.explode("terms").alias("term")).groupBy("term").agg(F.count("*").alias("df")).toArrow()
        df = np.zeros(len(queries.vocabulary), np.int64)  # a number for each term of the shard
        df[held.column("term").to_numpy()] = held.column("df").to_numpy()
        queries.weigh(df, n_docs, n_terms)
        weighed = spark.sparkContext.broadcast(queries)
        blocks = stored(index(listed, weighed), f"search-index-{number}")

        def search(batches, weighed=weighed):
            q = weighed.value
            best = Best(len(q.ids), p.top)
            for batch in batches:
                for r in range(batch.num_rows):
                    search_block({c: batch.column(i)[r].values.to_numpy() for i, c in enumerate(batch.schema.names)}, q, best)
            item = np.repeat(np.arange(len(q.ids)), [len(s) for s in best.score])
            doc = np.concatenate([*best.doc, np.zeros(0, np.int64)])
            yield pa.RecordBatch.from_arrays(
                [pa.array([q.ids[i] for i in item], pa.int64()),
                 pa.array(doc, pa.int64(), mask=doc == NO_ID), pa.array(np.concatenate([*best.score, np.zeros(0, np.int64)]), pa.int64())],
                names=["item_id", "doc_id", "score"])

        out = out.unionByName(blocks.mapInArrow(search, out.schema))
    order = Window.partitionBy("item_id").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return (out.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= p.top)
            .select("item_id", "rank", "doc_id", "score"))


def op13_lexical_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return ranked(docs, read_table(spark, sf_dir, "benchmark"))


#: Every document that shares a term with an item is scored.
ORACLE_SQL = r"""
WITH texts AS MATERIALIZED (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS t
  FROM documents),
items AS MATERIALIZED (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark),
totals AS (SELECT CAST(count(*) AS BIGINT) AS n_docs, CAST(sum(len(t)) AS BIGINT) AS n_terms FROM texts WHERE len(t) > 0),
tfs AS MATERIALIZED (
  SELECT doc_id, n, term, count(*) AS tf FROM (SELECT doc_id, len(t) AS n, unnest(t) AS term FROM texts)
  WHERE term IN (SELECT term FROM items) GROUP BY ALL),
weights AS (
  SELECT term, CAST(floor(1000 * ln((2 * n_docs + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tfs, totals GROUP BY term, n_docs),
impacts AS (
  SELECT doc_id, term, w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + ((90 * n * n_docs) // n_terms)))) AS impact
  FROM tfs JOIN weights USING (term), totals),
scores AS (SELECT item_id, doc_id, CAST(sum(impact) AS BIGINT) AS score FROM items JOIN impacts USING (term) GROUP BY ALL)
SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""
