"""Secret scans with multipart credential linking, in DataFrame functions only.

Base spans, leftmost and non-overlapping within a kind:

* ``assign``: a password, secret, token or API key assigned a value of six or more characters;
* ``access``: ``AKIA`` and more capitals or digits, 20 characters in all;
* ``hex``: a run of 24 or more lower-case hexadecimal digits.

A credential often comes in parts that say little alone.  Weak candidates are

* ``login``: a user, account or client identifier that is assigned a value;
* ``endpoint``: a URL, an assigned host, or an IPv4 address;
* ``opaque``: 32 or more base64 characters with a capital, a small letter and a digit, outside any base span.

They are reported only when a complementary part stands within ``scope`` code
points in the same document: a login or endpoint needs a secret (assign, hex or
opaque), an opaque needs an identifier (access or login) or an endpoint.  This is
an interval join: every part is listed in the buckets of ``scope`` code points
that its scope touches, weak parts look in their buckets for a complement
(left semi join, so no pair becomes a row), and the distance decides.

Positions come from the pieces between the matches: ``split`` and
``regexp_extract_all`` walk the same matches, and a running sum over one
document's pieces gives the code point each match starts at.  Texts are scanned
where they are read; only spans are shuffled.

Edge cases: a null or empty text has no spans (empty strings); rows that repeat
doc_id and text have the same spans; rows that repeat only the doc_id are told
apart by a hash of the text; equal starts are ordered by kind as listed; an empty
table gives an empty result; other columns are never read.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from stride.llm.common import read_table, stored


@dataclass(frozen=True)
class SecretParams:
    scope: int = 200  # code points between parts that belong together, at most


ASSIGN = r"""(?i)(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
LOGIN = r"""(?i)(?<![A-Za-z])(?:user(?:name)?|login|account|client_?id|access_?key_?id)["']?\x20*[:=]\x20*["']?([A-Za-z0-9_.@-]{3,})"""
ENDPOINT = (r"""https?://[^\s"'<>]{4,}|(?<![A-Za-z])(?i:host|endpoint|server)["']?\x20*[:=]\x20*["']?[A-Za-z0-9.-]{4,}(?::[0-9]+)?"""
            r"""|(?<![0-9.])(?:[0-9]{1,3}\.){3}[0-9]{1,3}(?![0-9.])""")
OPAQUE = r"(?<![A-Za-z0-9+/])[A-Za-z0-9+/]{32,}={0,2}"

#: kind -> (pattern, group whose length counts, least length)
BASE = {"assign": (ASSIGN, 2, 6), "access": ("AKIA[A-Z0-9]+", 0, 20), "hex": ("[0-9a-f]{24,}", 0, 24)}
WEAK = {"login": (LOGIN, 1, 3), "endpoint": (ENDPOINT, 0, 4), "opaque": (OPAQUE, 0, 32)}
KINDS = [*BASE, *WEAK]
SECRET, IDENTIFIER, PLACE = 1, 2, 4  # classes of parts
CLASS = {"assign": SECRET, "hex": SECRET, "opaque": SECRET, "access": IDENTIFIER, "login": IDENTIFIER, "endpoint": PLACE}
NEEDS = {"login": SECRET, "endpoint": SECRET, "opaque": IDENTIFIER | PLACE}


def has(kind: str, text: Column) -> Column:
    """A cheap test that a text can hold a span of the kind."""
    if kind == "assign":
        low = F.lower(text)
        return (low.contains("passw") | low.contains("secret") | low.contains("token") | low.contains("api"))
    if kind == "access":
        return text.contains("AKIA")
    if kind == "login":
        low = F.lower(text)
        return (low.contains("user") | low.contains("login") | low.contains("account") | low.contains("client")
                | low.contains("access"))
    if kind == "hex":
        return text.rlike("[0-9a-f]{24}")
    return text.rlike({"endpoint": ENDPOINT, "opaque": OPAQUE}[kind])


def matches(text: Column, kind: str) -> Column:
    """The matches of a kind in a text: array of (no, at, gap, size, part, match), closed by the piece after the last."""
    pattern, group, _ = {**BASE, **WEAK}[kind]
    lengths = lambda c: F.transform(c, lambda x: F.length(x))
    whole = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    part = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    zipped = F.arrays_zip(lengths(F.split(text, pattern, -1)).alias("gap"), lengths(whole).alias("size"),
                          lengths(part).alias("part"), whole.alias("match"))
    numbered = F.transform(zipped, lambda m, i: F.struct(F.lit(KINDS.index(kind)).alias("no"), i.alias("at"), m["gap"].alias("gap"),
                                                         m["size"].alias("size"), m["part"].alias("part"), m["match"].alias("match")))
    return F.when(has(kind, text), numbered)


def found(docs: DataFrame) -> DataFrame:
    """(doc_id, h, no, kind, start, end) of the matches of all kinds, from one scan of the texts."""
    none = F.array().cast("array<struct<no:int,at:int,gap:int,size:int,part:int,match:string>>")
    every = F.concat(*[F.coalesce(matches(F.col("text"), kind), none) for kind in KINDS])
    rows = (docs.select("doc_id", "h", F.explode(every).alias("m")).select("doc_id", "h", "m.*").where("size is not null").distinct())
    before = F.sum(F.col("gap").cast("long") + F.col("size")).over(
        Window.partitionBy("doc_id", "h", "no").orderBy("at").rowsBetween(Window.unboundedPreceding, 0))
    least = F.element_at(F.array(*[F.lit({**BASE, **WEAK}[kind][2]) for kind in KINDS]), F.col("no") + 1)
    mixed = F.col("match").rlike("[A-Z]") & F.col("match").rlike("[a-z]") & F.col("match").rlike("[0-9]")
    return (rows.withColumn("end", before)
            .where((F.col("part") >= least) & ((F.col("no") != KINDS.index("opaque")) | mixed))
            .select("doc_id", "h", "no", F.element_at(F.array(*map(F.lit, KINDS)), F.col("no") + 1).alias("kind"),
                    (F.col("end") - F.col("size")).alias("start"), "end"))


def _lookup(values: dict) -> Column:
    return F.element_at(F.create_map(*[F.lit(x) for kv in values.items() for x in kv]), F.col("kind"))


def linked(spans: DataFrame, p: SecretParams) -> DataFrame:
    """The weak spans beside which a complementary part stands."""
    weak = spans.where(F.col("kind").isin(list(WEAK)))
    base = spans.where(F.col("kind").isin(list(BASE)))
    bucket = lambda a, b: F.explode(F.sequence(F.floor(a / p.scope), F.floor(b / p.scope)))
    same = lambda: (F.col("w.doc_id").eqNullSafe(F.col("s.doc_id")) & (F.col("w.h") == F.col("s.h"))
                    & (F.col("w.bucket") == F.col("s.bucket")))
    # weak secrets inside a base span are that span
    own = weak.withColumn("bucket", bucket(F.col("start"), F.col("end")))
    cover = base.withColumn("bucket", bucket(F.col("start"), F.col("end")))
    inside = (own.where("kind = 'opaque'").alias("w").join(
        cover.alias("s"), same() & (F.col("w.start") < F.col("s.end")) & (F.col("s.start") < F.col("w.end")), "left_semi")
        .drop("bucket").distinct())
    weak = weak.join(inside.withColumn("gone", F.lit(True)), ["doc_id", "h", "no", "kind", "start", "end"], "left") \
        .where("gone is null").drop("gone")
    parts = base.unionByName(weak).withColumn("class", _lookup(CLASS))
    wide = parts.withColumn("bucket", bucket(F.greatest(F.col("start") - p.scope, F.lit(0)), F.col("end") + p.scope))
    asks = weak.withColumn("needs", _lookup(NEEDS)).withColumn("bucket", bucket(F.col("start"), F.col("end")))
    apart = F.greatest(F.col("w.start") - F.col("s.end"), F.col("s.start") - F.col("w.end"))
    return (asks.alias("w").join(wide.alias("s"), same() & (F.col("w.needs").bitwiseAND(F.col("s.class")) != 0)
                                 & (apart <= p.scope), "left_semi")
            .drop("bucket", "needs").distinct())


def scan(docs: DataFrame, p: SecretParams = SecretParams()) -> DataFrame:
    """(doc_id, h, no, kind, start, end) of all reported spans; ``h`` is xxhash64 of the text (null: empty)."""
    rows = docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text"))
    rows = rows.select("doc_id", F.xxhash64("text").alias("h"), "text")
    spans = stored(found(rows), "secret-spans")
    return spans.where(F.col("kind").isin(list(BASE))).unionByName(linked(spans, p))


def op9_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    spans = scan(docs)
    each = F.sort_array(F.collect_set(F.struct("start", "no", "kind", "end")))
    write = lambda c: F.array_join(F.transform(c, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")
    per = (spans.groupBy(F.col("doc_id").alias("s_id"), F.col("h").alias("s_h")).agg(each.alias("all"))
           .withColumn("base", F.filter("all", lambda s: s["no"] < len(BASE))))
    count = lambda kind: F.coalesce(F.size(F.filter("all", lambda s: s["kind"] == kind)), F.lit(0)).cast("long")
    left = docs.select("doc_id", F.xxhash64(F.coalesce("text", F.lit(""))).alias("h"))
    return (left.join(per, F.col("doc_id").eqNullSafe(F.col("s_id")) & (F.col("h") == F.col("s_h")), "left")
            .select("doc_id", *[F.when(F.col("all").isNull(), F.lit(0).cast("long")).otherwise(count(k)).alias(f"n_{k}") for k in BASE],
                    F.sha2(F.coalesce(write(F.col("base")), F.lit("")), 256).alias("base_sha256"),
                    F.coalesce(write(F.col("all")), F.lit("")).alias("spans")))
