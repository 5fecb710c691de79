"""Line dedup by a segment-partition edit join, in DataFrame functions only.

All lines that are not blank are compared for equality, those of at least ``min_chars``
code points also for edits; of equal lines and of lines within ``threshold`` edits the
first (by document, then its place there, then the line itself) stays.

1. Equal lines meet in one grouping with map-side combine: a line that a third
   of all documents share is one row per task.
2. *Segments.*  Two lines within ``threshold`` edits, one of them cut into
   ``threshold + 1`` even segments, have a segment of that line unchanged in the
   other.  Every distinct line is listed under (segment number, its length, hash
   of the segment) and probes the lists of its own and the next shorter lengths
   with the substrings that start where an unchanged segment can start: edits
   left of the segment shift it, and edits on both sides sum to the threshold
   (multi-match-aware selection).
3. *Content filter.*  An edit changes the counts of at most two letters, so
   pairs whose counts of eight letters differ by more than twice the threshold
   never leave the join: edited versions of one line that share a segment but
   differ in other words do not become rows.  Of the pairs that do, those where
   more than ``threshold`` of eight times as many, smaller segments are not found
   in place go next.
4. *Verification* by banded bit-parallel edit distance (Myers' vectors over the
   ``2 * threshold + 1`` diagonals that a distance within the threshold can
   touch), folded over the characters with ``aggregate``.

A line within ``threshold`` edits of an earlier line goes, whether or not that
one stays itself.  Lines within a document are told apart by their place.

Edge cases: null and empty texts have no line to drop; blank lines under ``min_chars``
always stay; rows that repeat a document whole are one document, and rows that
repeat only its doc_id count as one place for "first"; null doc_ids come last;
an empty table gives an empty result; other columns are carried, never read.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from stride.llm.common import read_table, stored


@dataclass(frozen=True)
class LineParams:
    threshold: int = 1
    min_chars: int = 40                # of lines compared for edits
    letters: str = "etanirso"          # of the content filter


def bits(name: str, *args) -> Column:
    return F.call_function(name, *[a if isinstance(a, Column) else F.lit(a) for a in args])


def segment(length: Column, i: int, pieces: int) -> tuple[Column, Column]:
    """Start (from 0) and length of even segment ``i`` (from 0) of a line; the last ones are longer by one."""
    base, short = F.floor(length / pieces).cast("int"), pieces - length % pieces
    return (base * i + F.greatest(F.lit(i) - short, F.lit(0))).cast("int"), base + (F.lit(i) >= short).cast("int")


def segment_key(line: Column, i: int, length: Column, start: Column, size: Column) -> Column:
    return F.xxhash64(F.lit(i), length, line.substr(start + 1, size))


def listed_keys(line: Column, length: Column, t: int) -> Column:
    return F.array(*[segment_key(line, i, length, *segment(length, i, t + 1)) for i in range(t + 1)])


def probed_keys(line: Column, length: Column, t: int) -> Column:
    """Keys of all substrings of a line that may be a segment of a line not longer than it."""
    keys = []
    for shorter in range(t + 1):
        other = (length - shorter).cast("int")
        for i in range(t + 1):
            start, size = segment(other, i, t + 1)
            for move in range(max(-i, shorter - (t - i)), min(i, shorter + (t - i)) + 1):
                at = start + move
                keys.append(F.when((at >= 0) & (at + size <= length), segment_key(line, i, other, at, size)))
    return F.array(*keys)  # null: no such place in the line


def letter_counts(line: Column, p: LineParams) -> Column:
    """Counts of eight letters, modulo 256, in the bytes of one number."""
    packed = F.lit(0).cast("long")
    for k, letter in enumerate(p.letters):
        n = F.length(line) - F.length(F.replace(line, F.lit(letter)))
        packed = packed.bitwiseOR(F.shiftleft((n % 256).cast("long"), 8 * k))
    return packed


def letters_differ(x: Column, y: Column, p: LineParams) -> Column:
    total = F.lit(0)
    for k in range(len(p.letters)):
        one = F.shiftrightunsigned(x, 8 * k).bitwiseAND(F.lit(255))
        d = F.abs(one - F.shiftrightunsigned(y, 8 * k).bitwiseAND(F.lit(255)))
        total = total + F.least(d, 256 - d)
    return total


def pieces_found(x: Column, length: Column, y: Column, pieces: int, t: int) -> Column:
    """How many of the ``pieces`` even segments of line ``x`` stand in ``y``, moved by at most ``t``.
    An edit spoils one piece at most."""
    found = F.lit(0)
    for i in range(pieces):
        start, size = segment(length, i, pieces)
        part = x.substr(start + 1, size)
        here = F.lit(False)
        for move in range(-t, t + 1):
            here = here | (y.substr(F.greatest(start + 1 + move, F.lit(1)), size) == part)
        found = found + here.cast("int")
    return found


def banded_distance(p: Column, q: Column, t: int) -> Column:
    """Edit distance of two lines given as arrays of characters, the shorter one
    first, lengths apart by at most ``t``; exact up to ``t``, larger beyond.  ``p`` and ``q``
    should be columns of a table, as ``p`` is looked up at every step.

    Bit ``k`` of a vector at character ``j`` of the longer line stands for row ``j - t + k`` of the shorter."""
    width = 2 * t + 1
    long_of = lambda x: F.lit(x).cast("long")
    mask = long_of((1 << width) - 1)

    def step(s: Column, c: Column) -> Column:
        j = s["j"] + 1
        same = long_of(0)
        for k in range(width):
            same = same.bitwiseOR(F.when(F.get(p, j - t + k - 1) == c, long_of(1 << k)).otherwise(long_of(0)))
        vp, vn = s["vp"], s["vn"]
        d0 = (same.bitwiseAND(vp) + vp).bitwiseXOR(vp).bitwiseOR(same).bitwiseOR(vn).bitwiseAND(mask)
        hp = vn.bitwiseOR(F.bitwise_not(d0.bitwiseOR(vp))).bitwiseAND(mask)
        hn = d0.bitwiseAND(vp)
        down = F.shiftrightunsigned(d0, 1)
        at = F.size(p) - j + t  # the row of the last character, once the longer line runs past it
        bit = lambda v: bits("shiftright", v, at).bitwiseAND(F.lit(1)).cast("int")
        add = F.when(j <= F.size(p), 1 - F.shiftright(d0, t).bitwiseAND(F.lit(1)).cast("int")).otherwise(bit(hp) - bit(hn))
        return F.struct(hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp))).bitwiseAND(mask).alias("vp"),
                        down.bitwiseAND(hp).alias("vn"), (s["d"] + add).alias("d"), j.alias("j"))

    first = F.struct(long_of(((1 << width) - 1) & ~((1 << t) - 1)).alias("vp"), long_of(0).alias("vn"),
                     F.lit(0).alias("d"), F.lit(0).alias("j"))
    return F.aggregate(q, first, step, lambda s: s["d"])


def line_rows(docs: DataFrame, p: LineParams) -> DataFrame:
    """(doc_id, rid, pos, line): the compared lines; ``rid`` tells rows of one doc_id with different texts apart."""
    return (docs.select("doc_id", F.xxhash64("text").alias("rid"), F.posexplode(F.split("text", "\n")).alias("pos", "line"))
            .where((F.length("line") >= p.min_chars) | F.col("line").rlike(r"[^\x20\x09-\x0D]")))


def near_lines(lines: DataFrame, p: LineParams) -> DataFrame:
    """(h, h2) of the lines that are within the threshold of an earlier line; ``lines``: distinct
    ones with their hashes, length and letter counts."""
    t = p.threshold
    index = lines.select(F.explode(listed_keys(F.col("line"), F.col("len"), t)).alias("key"), "h", "c")
    probe = lines.select(F.explode(probed_keys(F.col("line"), F.col("len"), t)).alias("key"), "h", "c").where("key is not null")
    pairs = stored(index.alias("x").join(probe.alias("y"), "key")
                   .where((F.col("x.h") != F.col("y.h")) & (letters_differ(F.col("x.c"), F.col("y.c"), p) <= 2 * t))
                   .select(F.least("x.h", "y.h").alias("a"), F.greatest("x.h", "y.h").alias("b")).distinct(), "line-pairs")
    named = stored(pairs.select(F.explode(F.array("a", "b")).alias("h")).distinct(), "line-named")
    text = stored(lines.join(named, "h", "left_semi").withColumn("chars", F.split("line", "")), "line-text")
    side = lambda c: text.select(F.col("h").alias(c), F.struct("doc", "pos", "line", "h", "h2", "chars").alias(f"t{c}"))
    order = lambda c: F.struct(F.col(f"{c}.doc"), F.col(f"{c}.pos"), F.col(f"{c}.line"))
    met = pairs.join(side("a"), "a").join(side("b"), "b")
    first = F.size("ta.chars") <= F.size("tb.chars")
    met = met.select(F.when(first, F.col("ta")).otherwise(F.col("tb")).alias("ta"),
                     F.when(first, F.col("tb")).otherwise(F.col("ta")).alias("tb"))
    pieces = 8 * (t + 1)
    near = met.where((F.size("tb.chars") - F.size("ta.chars") <= t)
                     & (pieces_found(F.col("ta.line"), F.size("ta.chars"), F.col("tb.line"), pieces, t) >= pieces - t)
                     & (banded_distance(F.col("ta.chars"), F.col("tb.chars"), t) <= t))
    later = F.when(order("ta") < order("tb"), F.col("tb")).otherwise(F.col("ta"))
    return near.select(later.alias("l")).select("l.h", "l.h2").distinct()


def dropped_lines(docs: DataFrame, p: LineParams = LineParams()) -> DataFrame:
    """(doc_id, rid, dropped): numbers of the lines that go, for documents that lose any."""
    place = F.coalesce("doc_id", F.lit(2 ** 63 - 1))
    lines = line_rows(docs, p)
    distinct = stored(lines.groupBy("line").agg(F.min(F.struct(place.alias("doc"), "pos")).alias("first"), F.count("*").alias("n"))
                      .select("line", "first.doc", "first.pos", "n", F.xxhash64("line").alias("h"),
                              F.xxhash64(F.lit("second"), "line").alias("h2"), F.length("line").alias("len"),
                              F.when(F.length("line") >= p.min_chars, letter_counts(F.col("line"), p)).alias("c")),
                      "line-distinct", "zstd")
    near = stored(near_lines(distinct.where(F.col("len") >= p.min_chars), p), "line-near").withColumn("near", F.lit(True))
    gone = stored(distinct.select("h", "h2", "doc", "n").join(near, ["h", "h2"], "left")
                  .where("n > 1 or near").select("h", "h2", "doc", "near"), "line-gone")
    there = lines.select("doc_id", "rid", "pos", F.xxhash64("line").alias("h"), F.xxhash64(F.lit("second"), "line").alias("h2"))
    found = (there.join(gone, ["h", "h2"])
             .groupBy("doc_id", "rid", "h", "h2")
             .agg(F.sort_array(F.collect_set("pos")).alias("at"), F.min("doc").alias("doc"), F.max("near").alias("near")))
    out = F.when(F.col("near") | (place != F.col("doc")), F.col("at")).otherwise(F.expr("slice(at, 2, size(at))"))
    return (found.select("doc_id", "rid", out.alias("at")).where(F.size("at") > 0)
            .groupBy("doc_id", "rid").agg(F.sort_array(F.flatten(F.collect_list("at"))).alias("dropped")))


def _with_dropped(docs: DataFrame, p: LineParams, *columns: Column) -> DataFrame:
    """Columns of ``docs`` beside the numbers of the lines each row loses (empty: none)."""
    gone = dropped_lines(docs, p).select(F.col("doc_id").alias("_id"), F.col("rid").alias("_rid"), "dropped")
    left = docs.select(*columns, F.xxhash64("text").alias("__rid"), F.col("doc_id").alias("__id"))
    return (left.join(gone, F.col("__id").eqNullSafe(F.col("_id")) & (F.col("__rid") == F.col("_rid")), "left")
            .withColumn("__dropped", F.coalesce("dropped", F.array().cast("array<int>"))))


def op4_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    n = F.coalesce(F.size(F.split("text", "\n")), F.lit(0))
    rows = _with_dropped(docs, LineParams(), F.col("doc_id"), F.when(F.col("text").isNull(), 0).otherwise(n).alias("n_lines"))
    return rows.select("doc_id", "n_lines", (F.col("n_lines") - F.size("__dropped")).alias("n_kept"),
                       F.array_join("__dropped", ",").alias("dropped"))


def line_dedup_stage(spark: SparkSession, docs: DataFrame, sf_dir: str, p: LineParams = LineParams()) -> DataFrame:
    """Texts without the lines that go (n_chars follows).  A document that loses
    all it had, a copy of earlier ones, goes; one that had no text stays."""
    rows = _with_dropped(docs.withColumnsRenamed({c: f"c_{c}" for c in docs.columns if c not in ("doc_id", "text")}),
                         p, F.col("*"))
    lines = F.split("text", "\n")
    kept = F.transform(F.array_except(F.sequence(F.lit(0), F.size(lines) - 1), F.col("__dropped")), lambda i: F.get(lines, i))
    text = F.when(F.size("__dropped") == 0, F.col("text")).otherwise(F.array_join(kept, "\n"))
    rows = rows.withColumn("__text", text).where((F.size("__dropped") == 0) | F.col("__text").rlike(r"\S"))
    new = {"doc_id": F.col("doc_id"), "text": F.col("__text")}
    if "n_chars" in docs.columns:
        new["n_chars"] = F.when(F.size("__dropped") == 0, F.col("c_n_chars")).otherwise(
            F.length("__text").cast(docs.schema["n_chars"].dataType))
    return rows.select(*[(new[c] if c in new else F.col(f"c_{c}")).alias(c) for c in docs.columns])


#: One edit apart: the common prefix and suffix cover all but one character of the longer line;
#: of 40 or more characters, the first or the last 16 are then equal.
ORACLE_SQL = r"""
WITH numbered AS (
  SELECT doc_id, unnest(string_split(text, chr(10))) AS line,
         unnest(range(len(string_split(text, chr(10))))) AS pos
  FROM documents WHERE text IS NOT NULL),
compared AS (SELECT * FROM numbered WHERE length(line) >= 40 OR regexp_matches(line, '[^\x20\x09-\x0D]')),
lines AS (SELECT line, min(doc_id) AS doc, arg_min(pos, (doc_id, pos)) AS pos FROM compared GROUP BY line),
long_lines AS (SELECT * FROM lines WHERE length(line) >= 40),
met AS (
  SELECT a.line AS x, b.line AS y FROM long_lines a JOIN long_lines b
    ON left(a.line, 16) = left(b.line, 16) AND a.line < b.line AND abs(length(a.line) - length(b.line)) <= 1
  UNION
  SELECT a.line, b.line FROM long_lines a JOIN long_lines b
    ON right(a.line, 16) = right(b.line, 16) AND a.line < b.line AND abs(length(a.line) - length(b.line)) <= 1),
near AS (
  SELECT x, y FROM met
  WHERE len(list_filter(range(1, 1 + least(length(x), length(y))), lambda i: left(x, i) = left(y, i)))
      + len(list_filter(range(1, 1 + least(length(x), length(y))), lambda i: right(x, i) = right(y, i)))
      >= greatest(length(x), length(y)) - 1),
later AS (
  SELECT DISTINCT CASE WHEN (a.doc, a.pos, a.line) < (b.doc, b.pos, b.line) THEN b.line ELSE a.line END AS line
  FROM near JOIN lines a ON a.line = x JOIN lines b ON b.line = y),
own AS (SELECT doc_id, line, min(pos) AS first_pos FROM compared GROUP BY doc_id, line),
gone AS (
  SELECT c.doc_id, c.pos FROM compared c JOIN lines l ON l.line = c.line
    JOIN own o ON o.doc_id = c.doc_id AND o.line = c.line LEFT JOIN later n ON n.line = c.line
  WHERE n.line IS NOT NULL OR c.doc_id <> l.doc OR c.pos > o.first_pos),
per AS (SELECT doc_id, count(*) AS n, string_agg(CAST(pos AS VARCHAR), ',' ORDER BY pos) AS dropped FROM gone GROUP BY doc_id)
SELECT d.doc_id, CAST(CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END AS INTEGER) AS n_lines,
       CAST(CASE WHEN text IS NULL THEN 0 ELSE len(string_split(text, chr(10))) END - coalesce(per.n, 0) AS INTEGER) AS n_kept,
       coalesce(per.dropped, '') AS dropped
FROM documents d LEFT JOIN per ON per.doc_id = d.doc_id
"""
