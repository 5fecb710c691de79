"""Document fingerprints by a homomorphic multiset hash, in DataFrame functions only.

A document is the multiset of its paragraphs (lines).  Every paragraph is hashed
to a wide vector, and the fingerprint is the sum of the vectors modulo 2**32 in
each lane, so that

* equal multisets of paragraphs have equal fingerprints, in any order;
* adding or deleting a paragraph adds or subtracts its vector (``combine``),
  without the rest of the text.

A vector has ``STRONG`` lanes drawn from two 64-bit hashes of the paragraph, which
tell multisets apart, and ``SOFT`` lanes that sum the signs (+1, -1) of the bits
of its word pairs' hashes.  The soft lanes are a linear sketch: the cosine of two
documents' soft lanes estimates that of their word-pair counts (standard error
about 1/sqrt(SOFT)), which gives the likeness of two fingerprints without texts.

Every text is split and exploded where it is read; word pairs are summed in the
map-side combine, so one row per document and task is shuffled.  The next
document of the edited text comes from ranges of (doc_id, text hash): order
inside a range by a window, across ranges by the first row of each, as many rows
as there are partitions.

Edge cases: a null text is empty; an empty text has one empty paragraph; rows
that repeat doc_id and text are one document and come out once; rows that
repeat only the doc_id are ordered by the hash of the text; null doc_ids come
first; the only document is its own next; an empty table gives an empty result;
other columns are never read.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stride.llm.common import read_table, stored

STRONG, SOFT = 8, 64
LANE = 2 ** 32


def lanes_of(texts: DataFrame, keys: list[str], text: str) -> DataFrame:
    """``keys`` and ``lanes`` (array of long below 2**32): the fingerprint vector of each row's text."""
    paragraphs = texts.select(*keys, F.explode(F.split(text, "\n")).alias("__par"))
    words = paragraphs.withColumn("__words", F.split("__par", " "))
    pair = lambda h, p: F.struct(h.alias("__a"), p.alias("__b"))
    features = F.concat(
        F.array(pair(F.xxhash64("__par"), F.xxhash64(F.lit("second"), "__par"))),
        F.transform("__words", lambda w, i: pair(F.xxhash64(w, F.get("__words", i + 1)), F.lit(None).cast("long"))))
    rows = words.select(*keys, F.explode(features).alias("__f")).select(*keys, "__f.__a", "__f.__b")
    strong = [F.sum(F.when(F.col("__b").isNotNull(), F.xxhash64("__a", "__b", F.lit(i)).bitwiseAND(F.lit(LANE - 1)))
                    .otherwise(F.lit(0).cast("long"))) for i in range(STRONG)]
    count = F.sum(F.when(F.col("__b").isNull(), F.lit(1).cast("long")).otherwise(F.lit(0).cast("long")))
    ones = [F.sum(F.when(F.col("__b").isNull(), F.shiftrightunsigned("__a", i).bitwiseAND(F.lit(1)))
                  .otherwise(F.lit(0).cast("long"))) for i in range(SOFT)]
    summed = rows.groupBy(*keys).agg(count.alias("__n"), *[c.alias(f"s{i}") for i, c in enumerate(strong)],
                                     *[c.alias(f"o{i}") for i, c in enumerate(ones)])
    lanes = [F.col(f"s{i}") for i in range(STRONG)] + [2 * F.col(f"o{i}") - F.col("__n") for i in range(SOFT)]
    return summed.select(*keys, F.array(*[F.pmod(x, F.lit(LANE)) for x in lanes]).alias("lanes"))


def combine(a: Column, b: Column, sign: int = 1) -> Column:
    """Lanes of the union (``sign`` 1) or difference (-1) of two multisets."""
    return F.zip_with(a, b, lambda x, y: F.pmod(x + sign * y, F.lit(LANE)))


def to_text(lanes: Column) -> Column:
    return F.array_join(F.transform(lanes, lambda x: F.lpad(F.lower(F.hex(x)), 8, "0")), "")


def likeness(a: Column, b: Column) -> Column:
    """1 for equal lanes, else the cosine of the soft lanes, not below 0."""
    soft = lambda x: F.transform(F.slice(x, STRONG + 1, SOFT),
                                 lambda v: F.when(v >= LANE // 2, v - LANE).otherwise(v).cast("double"))
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda u, v: u * v), F.lit(0.0), lambda s, v: s + v)
    x, y = soft(a), soft(b)
    norm = F.sqrt(dot(x, x) * dot(y, y))
    cosine = F.when(norm > 0, dot(x, y) / norm).otherwise(0.0)
    return F.when(a == b, 1.0).otherwise(F.least(F.greatest(cosine, F.lit(0.0)), F.lit(1.0)))


def following(ids: DataFrame) -> DataFrame:
    """``ids`` (doc_id, h, ...) with the next row's doc_id and h in ascending order (after the last: the first)."""
    spark = ids.sparkSession
    pieces = int(spark.conf.get("spark.sql.shuffle.partitions"))
    ranged = stored(ids.repartitionByRange(pieces, "doc_id", "h").withColumn("part", F.spark_partition_id()), "fp-range")
    here = F.struct("doc_id", "h")
    firsts = ranged.groupBy("part").agg(F.min(here).alias("first"))  # a row for each partition
    over = Window.orderBy("part")
    all_parts = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    after = firsts.select("part", F.coalesce(F.lead("first").over(over), F.first("first").over(all_parts)).alias("after"))
    within = Window.partitionBy("part").orderBy("doc_id", "h")
    return (ranged.withColumn("then", F.lead(here).over(within)).join(F.broadcast(after), "part")
            .withColumn("then", F.coalesce("then", "after"))
            .select(*ids.columns, F.col("then.doc_id").alias("next_id"), F.col("then.h").alias("next_h")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """The columns of ``op6_fingerprint`` for ``docs`` (doc_id, text)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("h"), "text")
    ids = rows.groupBy("doc_id", "h").agg(F.max(F.length("text")).alias("n"))
    nexts = stored(following(ids), "fp-next")
    same = lambda i, k: F.col("doc_id").eqNullSafe(F.col(i)) & (F.col("h") == F.col(k))
    k = F.floor(F.col("n") / 2).cast("int")
    wanted = nexts.select(F.col("next_id"), F.col("next_h"), k.alias("k"), F.col("doc_id").alias("own_id"),
                          F.col("h").alias("own_h"), F.col("n").alias("own_n"))
    heads = (rows.join(wanted, same("next_id", "next_h"))
             .select("own_id", "own_h", "own_n", "k", F.col("text").substr(F.lit(1), F.col("k")).alias("head"))
             .dropDuplicates(["own_id", "own_h"]))
    both = (rows.join(heads, same("own_id", "own_h"))
            .select("doc_id", "h", F.col("own_n").alias("n"), "text",
                    F.concat(F.col("text").substr(F.lit(1), F.col("own_n") - F.col("k")), "head").alias("edited"))
            .select("doc_id", "h", "n", F.sha2("edited", 256).alias("sha"),
                    F.explode(F.array(F.struct(F.lit(0).alias("which"), F.col("text").alias("body")),
                                      F.struct(F.lit(1).alias("which"), F.col("edited").alias("body")))).alias("v"))
            .select("doc_id", "h", "n", "sha", "v.which", "v.body"))
    prints = stored(lanes_of(both, ["doc_id", "h", "n", "sha", "which"], "body"), "fp-lanes")
    own = prints.where("which = 0").select("doc_id", "h", "n", "sha", "lanes")
    edited = prints.where("which = 1").select(F.col("doc_id").alias("e_id"), F.col("h").alias("e_h"), F.col("lanes").alias("e"))
    link = nexts.select(F.col("doc_id").alias("l_id"), F.col("h").alias("l_h"), "next_id", "next_h")
    # the next document's lanes, carried to the document
    after = (own.select("doc_id", "h", F.col("lanes").alias("x")).join(link, same("next_id", "next_h"))
             .select("l_id", "l_h", "x"))
    return (own.join(edited, same("e_id", "e_h")).join(after, same("l_id", "l_h"))
            .select("doc_id", F.col("n").cast("long").alias("n_chars"), F.col("sha").alias("edited_sha256"),
                    to_text(F.col("lanes")).alias("fingerprint"), to_text(F.col("e")).alias("edited_fingerprint"),
                    likeness(F.col("lanes"), F.col("e")).alias("near_edited"),
                    likeness(F.col("lanes"), F.col("x")).alias("near_next")))


def op6_fingerprint(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(read_table(spark, sf_dir, "documents"))
