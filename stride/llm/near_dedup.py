"""Near-duplicate documents by bottom-k sketches of one hash function.

A document's shingles are hashed once; its sketch is the ``k`` smallest hashes.
Documents with equal shingle sets are one *class* (found by a digest, never
compared).  Between classes:

1. *Inverted lists of the retained values.*  For a similarity of at least ``s``,
   the ``k`` smallest hashes of the union contain a binomial(k, s) number of
   common ones, all of which both sketches hold, so two similar sketches share
   at least ``need(k)`` values (missed with a chance below 1e-6).  By the prefix
   principle it is enough to list each sketch under its rarest
   ``size - need + 1`` values: common lines and passages drop out of the lists,
   because values of high frequency come last.  A class whose prefix has no
   value in common with any other class can have no partner and goes no further.
   A short sketch (64 values) picks the classes that go on; a long one (256
   values, the whole set for most documents) makes the lists of these.
2. *Overlaps.*  Every list has a pivot, the class with the fewest rarer values
   (the likely original of a group of copies); all others are paired with it.
   After these links are joined to components, only pairs of a list whose
   components still differ are generated, under bounds on the overlap they could
   have: by size, by position in the lists, and by parities: a value that only one of two
   sets has turns one bit, so bits that differ are no more than the values not
   shared.  The first pass compares 256 bits of the sketches, the second a
   signature of the whole sets with at least two bits a value, which tells sets of a
   similarity a few hundredths below the least one from a pair.  A group of thousands of
   copies thus makes rows for its links and near misses, not for its square.
3. *Union-sketch estimate.*  The ``k`` smallest values of both sketches together
   are a sketch of the union; pairs with fewer than ``need(k)`` common ones go.
   When both sketches hold their whole sets this count is already exact.
4. *Exact Jaccard* on the full sets of the pairs that remain.

Components are smallest labels passed along the links with pointer jumping, a
written table each round.  Nothing is collected to the driver; keys shared by a
third of the rows meet only in partial aggregates and in joins of two plain
shuffles, which adaptive execution splits.

Edge cases: null, empty and blank texts have an empty set and link with nothing;
a text of fewer words than a shingle is one shingle; rows that repeat a doc_id
are one document with either text; a null doc_id links with nothing (its
component_id is null and it is kept); empty tables give empty results; other
columns are carried by the stage and never read.
"""
from __future__ import annotations

import hashlib
import math
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stride.llm.common import map_texts, mix64, read_table, stored, words_of


@dataclass(frozen=True)
class NearParams:
    words: int = 5         # words of a shingle
    percent: int = 80      # least 100 * |A and B| / |A or B|
    short: int = 64        # sketch that picks the classes with a possible partner
    long: int = 256        # sketch that makes the lists

    def need(self, k: int) -> int:
        """Common values among ``k`` of a union that a similar pair has, but for a chance of 1e-6."""
        s = self.percent / 100
        tail, c = 0.0, 0
        while c <= k:
            tail += math.exp(math.lgamma(k + 1) - math.lgamma(c + 1) - math.lgamma(k - c + 1)
                             + c * math.log(s) + (k - c) * math.log1p(-s)) if s < 1 else float(c == k)
            if tail > 1e-6:
                return c
            c += 1
        return k


def shingle_sets(texts: list[str], words: int) -> list[np.ndarray]:
    """Sorted distinct shingle hashes of each text (whole texts)."""
    h, text = words_of(texts, space=True)
    counts = np.bincount(text, minlength=len(texts)) if len(text) else np.zeros(len(texts), np.int64)
    salt = [np.uint64((0x9E3779B97F4A7C15 * (2 * i + 3)) & (2 ** 64 - 1)) for i in range(words + 1)]
    acc = np.zeros(max(len(h) - words + 1, 0), dtype=np.uint64)
    for j in range(words):
        acc += mix64(h[j:j + len(acc)] * salt[j] + salt[j])
    full = mix64(acc)
    out, at = [], 0
    for n in counts:
        if n >= words:
            out.append(np.unique(full[at:at + n - words + 1]).view(np.int64))
        elif n:
            whole = np.array(salt[words:]) * np.uint64(n)
            for j in range(n):
                whole = whole + mix64(h[at + j:at + j + 1] * salt[j] + salt[j])
            out.append(mix64(whole).view(np.int64))
        else:
            out.append(np.zeros(0, np.int64))
        at += n
    for i, s in enumerate(out):
        s.sort()
    return out


def sketches(docs: DataFrame, p: NearParams) -> DataFrame:
    """(doc_id, n_shingles, set_id, head): set digest and the short sketch."""
    words, k = p.words, p.short

    def sketch(texts):
        sets = shingle_sets(texts, words)
        return {"n_shingles": [len(s) for s in sets], "head": [s[:k] for s in sets],
                "set_id": [hashlib.blake2b(s.tobytes(), digest_size=16).hexdigest() if len(s) else None for s in sets]}

    return map_texts(docs, ["doc_id"], "n_shingles long, set_id string, head array<long>", sketch)


def full_sets(docs: DataFrame, p: NearParams) -> DataFrame:
    """(v, n, head, bits, sig, whole): the long sketch, the parities of its values per
    last byte (256 bits), those of the full set in two to four bits a value (256 to 16,384
    in all), and, where the sketch is not whole, the full set."""
    words, k = p.words, p.long

    def bits(values, wide=256):
        odd = np.bincount(values & (wide - 1), minlength=wide) & 1
        return np.packbits(odd.astype(np.uint8)).view(np.int64)

    def sig(values):
        return bits(values, 1 << min(max((2 * len(values) - 1).bit_length(), 8), 14))

    def make(texts):
        sets = shingle_sets(texts, words)
        return {"n": [len(s) for s in sets], "head": [s[:k] for s in sets], "bits": [bits(s[:k]) for s in sets],
                "sig": [sig(s) for s in sets], "whole": [s if len(s) > k else None for s in sets]}

    return map_texts(docs, ["v"], "n long, head array<long>, bits array<long>, sig array<long>, whole array<long>", make)


def prefixes(sets: DataFrame, k: int, p: NearParams) -> DataFrame:
    """(v, n, size, value, pos) of the values under which a class is listed:
    ``pos`` counts the values before it in the order of rising frequency; values
    that no other class has are the rarest and need no list."""
    need = p.need(k)
    exact = int(k * p.percent / 100)  # sets of at most so many: a partner's sketch is whole
    rows = sets.select("v", "n", F.explode("head").alias("value"))
    # a value that only texts of one document have can link nothing
    shared = stored(rows.groupBy("value").agg(F.count("*").alias("df"), F.min("v").alias("low"), F.max("v").alias("high"))
                    .where("low < high").select("value", "df"), "near-df")
    size = F.least("n", F.lit(k))
    least = F.when(F.col("n") <= exact, F.ceil(F.col("n") * p.percent / 100.0)).otherwise(
        F.least(F.lit(need), F.ceil(F.col("n") * p.percent / 100.0)))
    listed = (rows.join(shared, "value")
              .groupBy("v", "n").agg(F.sort_array(F.collect_list(F.struct("df", "value"))).alias("vals"))
              .withColumn("size", size).withColumn("unique", F.col("size") - F.size("vals"))
              .withColumn("prefix", F.col("size") - least + 1)
              .where("prefix > unique"))
    return (listed.select("v", "n", "size", "unique", F.posexplode(
                F.expr("slice(vals, 1, cast(prefix - unique as int))")).alias("at", "val"))
            .select("v", "n", "size", F.col("val.value").alias("value"), (F.col("unique") + F.col("at")).alias("pos")))


def could_link(a: str, b: str, p: NearParams):
    """Size and position bounds on the overlap of two classes of one list, and the overlap of their
    sketches that a link needs."""
    s = p.percent / 100
    exact, need = int(p.long * s), p.need(p.long)
    col = lambda t, c: F.col(f"{t}.{c}")
    reach = F.least(col(a, "size") - col(a, "pos"), col(b, "size") - col(b, "pos"))
    both_whole = (col(a, "n") <= exact) & (col(b, "n") <= exact)
    overlap = F.when(both_whole, F.ceil((col(a, "n") + col(b, "n")) * (s / (1 + s)) - 1e-9)).otherwise(
        F.least(F.lit(need), F.ceil(F.least(col(a, "n"), col(b, "n")) * s - 1e-9)))
    return ((F.least(col(a, "n"), col(b, "n")) * 100 >= F.greatest(col(a, "n"), col(b, "n")) * p.percent)
            & (reach >= overlap)), overlap


def sketches_meet(a: str, b: str, p: NearParams):
    """``could_link`` and the parities of the sketches: differing bits are at most the values not shared."""
    bounds, overlap = could_link(a, b, p)
    apart = sum((F.bit_count(F.get(F.col(f"{a}.bits"), F.lit(i)).bitwiseXOR(F.get(F.col(f"{b}.bits"), F.lit(i))))
                 for i in range(4)), F.lit(0))
    return bounds & (apart <= F.col(f"{a}.size") + F.col(f"{b}.size") - 2 * overlap)


def sets_meet(a: str, b: str, p: NearParams):
    """``could_link`` and the signatures of the whole sets; the longer one is folded to the other's length."""
    bounds, _ = could_link(a, b, p)
    one, two = F.col(f"{a}.sig"), F.col(f"{b}.sig")

    def as_long_as(x, other):
        half = F.size(other)
        folded = F.zip_with(F.slice(x, F.lit(1), half), F.slice(x, half + 1, half), lambda u, v: u.bitwiseXOR(v))
        return F.when(F.size(x) > half, folded).otherwise(x)

    differ = F.zip_with(as_long_as(one, two), as_long_as(two, one), lambda u, v: F.bit_count(u.bitwiseXOR(v)))
    total = F.col(f"{a}.n") + F.col(f"{b}.n")
    shared = F.ceil(total * p.percent / (100.0 + p.percent) - 1e-9)  # the least overlap of similar sets
    return bounds & (F.aggregate(differ, F.lit(0), lambda x, y: x + y) <= total - 2 * shared)


def verified(pairs: DataFrame, sets: DataFrame, p: NearParams) -> DataFrame:
    """The pairs (a, b) of similar classes: union-sketch estimate, then exact Jaccard."""
    k, need = p.long, p.need(p.long)
    side = lambda c, t: sets.select(F.col("v").alias(c), F.col("n").alias(f"n{t}"), F.col("head").alias(f"h{t}"))
    near = pairs.join(side("a", 1), "a").join(side("b", 2), "b")
    both = F.array_intersect("h1", "h2")
    union = F.slice(F.sort_array(F.array_union("h1", "h2")), 1, k)
    whole = (F.col("n1") <= k) & (F.col("n2") <= k)
    similar = lambda m: m * 100 >= p.percent * (F.col("n1") + F.col("n2") - m)
    sketch = (F.size(both) >= need) & (F.size(F.array_intersect(union, both)) >= need)
    passed = stored(near.where(F.when(whole, similar(F.size(both))).otherwise(sketch))
                    .select("a", "b", whole.alias("exact")), "near-passed")
    rest = lambda c, t: sets.select(F.col("v").alias(c), F.col("n").alias(f"n{t}"),
                                    F.coalesce("whole", "head").alias(f"s{t}"))
    m = F.size(F.array_intersect("s1", "s2"))
    exact = (passed.where("not exact").join(rest("a", 1), "a").join(rest("b", 2), "b")
             .withColumn("m", m).where(similar(F.col("m"))).select("a", "b"))
    return passed.where("exact").select("a", "b").unionByName(exact).distinct()


def components(links: DataFrame) -> DataFrame:
    """(v, label): the smallest vertex reachable over the links (a, b)."""
    both = stored(links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b"))), "near-both")
    labels = stored(both.groupBy(F.col("a").alias("v")).agg(F.least(F.min("b"), F.col("a")).alias("label")), "near-label")
    while True:
        seen = (both.join(labels.select(F.col("v").alias("a"), "label"), "a")
                .groupBy(F.col("b").alias("v")).agg(F.min("label").alias("seen")))
        passed = stored(labels.join(seen, "v", "left").select(
            "v", F.least("label", F.coalesce("seen", "label")).alias("label"), F.col("label").alias("old")), "near-pass")
        jump = passed.select(F.col("v").alias("label"), F.col("label").alias("further"))
        moved = stored(passed.join(jump, "label", "left").select(
            "v", F.least("label", F.coalesce("further", "label")).alias("label"), "old"), "near-label")
        labels = moved.select("v", "label")
        if moved.where("label <> old").isEmpty():
            return labels


def near_duplicates(docs: DataFrame, p: NearParams = NearParams()) -> DataFrame:
    """(doc_id, n_shingles, component_id, kept, n_links), a row for each document."""
    table = stored(sketches(docs, p), "near-sketch")
    known = table.where("set_id is not null and doc_id is not null")
    classes = stored(known.groupBy("set_id").agg(F.min("doc_id").alias("v")), "near-class")
    first = known.join(classes, "set_id").where("doc_id = v")
    vectors = stored(first.select("v", F.col("n_shingles").alias("n"), "head", "set_id")
                     .dropDuplicates(["v", "set_id"]).drop("set_id"), "near-vector")
    going = stored(prefixes(vectors, p.short, p).select("v").distinct(), "near-going")
    named = docs.select(F.col("doc_id").alias("v"), "text").join(going, "v")
    sets = stored(full_sets(named, p), "near-set")
    lists = stored(prefixes(sets.select("v", "n", "head"), p.long, p).join(sets.select("v", "bits"), "v"), "near-list")
    pivots = stored(lists.groupBy("value").agg(F.min(F.struct("pos", "v", "n", "size", "bits")).alias("p"))
                    .select("value", "p.*"), "near-pivot")
    tried = stored(lists.alias("x").join(pivots.alias("y"), "value")
                   .where((F.col("x.v") != F.col("y.v")) & sketches_meet("x", "y", p))
                   .select(F.least("x.v", "y.v").alias("a"), F.greatest("x.v", "y.v").alias("b")).distinct(), "near-try")
    # texts of one document are one document, whichever class each is in
    of_doc = known.join(classes, "set_id").select("doc_id", "v").distinct()
    several = of_doc.groupBy("doc_id").agg(F.min("v").alias("low"), F.max("v").alias("high")).where("low < high")
    own = of_doc.join(several, "doc_id").where("v > low").select(F.col("low").alias("a"), F.col("v").alias("b"))
    links = stored(verified(tried, sets, p).unionByName(own).distinct(), "near-link")
    part = components(links)
    grouped = stored(lists.join(part, "v", "left").withColumn("label", F.coalesce("label", "v")), "near-group")
    # lists that still hold several components: the members outside the pivot's component meet the others
    heads = stored(pivots.select("value", "v").join(part, "v", "left")
                   .select("value", F.coalesce("label", "v").alias("main")), "near-main")
    marked = grouped.drop("bits").join(heads, "value")
    undecided = marked.where("label <> main").select("value").distinct()
    rows = stored(marked.join(undecided, "value", "left_semi").join(sets.select("v", "sig"), "v"), "near-marked")
    cross = (rows.where("label <> main").alias("x").join(rows.alias("y"), "value")
             .where((F.col("x.label") != F.col("y.label"))
                    & ((F.col("y.label") == F.col("y.main")) | (F.col("x.v") < F.col("y.v"))) & sets_meet("x", "y", p))
             .select(F.least("x.v", "y.v").alias("a"), F.greatest("x.v", "y.v").alias("b")).distinct()
             .join(tried, ["a", "b"], "left_anti"))
    more = stored(verified(stored(cross, "near-cross"), sets, p), "near-more")
    label = components(links.unionByName(more))
    out = table.join(classes, "set_id", "left").join(label, "v", "left")
    component = F.when(F.col("doc_id").isNotNull(), F.coalesce("label", "v", "doc_id"))
    return out.select("doc_id", "n_shingles", component.alias("component_id"),
                      F.coalesce(F.col("doc_id") == component, F.lit(True)).alias("kept"))


def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    return near_duplicates(docs, NearParams(words=3, percent=85))


def near_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group (the smallest doc_id), columns as they came;
    rows that repeat a doc_id stay or go together."""
    gone = near_duplicates(docs.select("doc_id", "text")).where("not kept").select("doc_id").distinct()
    return docs.join(gone, "doc_id", "left_anti").select(*docs.columns)


#: Every pair that shares a shingle is counted; components by reachability.
ORACLE_SQL = r"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w
  FROM documents),
lists AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN CAST([] AS VARCHAR[]) WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END AS s
  FROM words),
shingles AS (SELECT DISTINCT doc_id, unnest(s) AS sh FROM lists),
sizes AS (SELECT doc_id, count(*) AS n FROM shingles GROUP BY doc_id),
common AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS m
  FROM shingles a JOIN shingles b ON a.sh = b.sh AND a.doc_id < b.doc_id GROUP BY 1, 2),
links AS (
  SELECT x, y FROM common JOIN sizes p ON p.doc_id = x JOIN sizes q ON q.doc_id = y
  WHERE 100 * m >= 85 * (p.n + q.n - m)),
both_ways AS (SELECT x, y FROM links UNION SELECT y, x FROM links),
reach(doc, there) AS (
  SELECT x, y FROM both_ways UNION SELECT r.doc, b.y FROM reach r JOIN both_ways b ON r.there = b.x),
least_reached AS (SELECT doc, min(there) AS low FROM reach GROUP BY doc)
SELECT l.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_shingles, least(l.doc_id, coalesce(low, l.doc_id)) AS component_id,
       coalesce(low, l.doc_id) >= l.doc_id AS kept
FROM lists l LEFT JOIN sizes ON sizes.doc_id = l.doc_id LEFT JOIN least_reached ON doc = l.doc_id
"""
