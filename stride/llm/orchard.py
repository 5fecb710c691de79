"""Vector code compression: product codes whose nearest entries come from Orchard's search.

A vector's components become integers and the vector is cut into consecutive
parts; each part position has a codebook that a fixed number of assign-and-average
rounds moves, and a code is the index of the nearest entry of each part.

*Orchard's search.*  Every codebook entry keeps the list of all entries sorted by
their distance from it.  A search starts at the best of a few spaced entries and
walks the list of its current entry; an entry that is nearer becomes the current
one and its list is walked from the start; entries compared before are marked and
passed over.  The walk ends beyond twice the current distance, where by the
triangle inequality nothing nearer (nor as near) can lie, so results are exact.
Lists are walked in short stretches, for all vectors of a batch at once.

A round is one map over the written vectors and one partial aggregate: a task adds
up its parts by entry and emits at most ``entries * dimension`` numbers, whatever
it read.  Only codebooks (``entries * dimension`` integers) pass through the driver.
The lists of a codebook (``entries ** 2`` numbers) are built where they are used.

Edge cases: rows whose vector is null or holds a null or non-finite component are
dropped; so are rows whose vector has another length than that of the smallest id;
components of ``2**24 / scale`` or more in size count as that much (distances stay
in 64 bits); a length that the number of parts does not divide is cut at
``i * length // parts``; fewer rows than entries make a smaller codebook; equal
vectors and repeated ids are rows of their own; a null id comes after all others
when first entries are chosen; an empty table gives an empty result; other columns
are never read.
"""
from __future__ import annotations

import hashlib
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType

from stride.llm.common import read_table, stored

LIMIT = 1 << 24      # largest component, as an integer
FAR = np.iinfo(np.int64).max


@dataclass(frozen=True)
class CodeParams:
    parts: int = 4
    entries: int = 256
    rounds: int = 4
    scale: int = 1024
    stretch: int = 16     # list places looked at together
    rows: int = 2048      # vectors searched together
    salts: int = 16       # pieces of a group when its sum is joined back


class Orchard:
    """Distance-sorted neighbour lists of the entries of one codebook."""

    def __init__(self, entries: np.ndarray, stretch: int):
        self.entries, self.stretch = entries, stretch
        k = len(entries)
        gaps = np.stack([((entries - e) ** 2).sum(axis=1) for e in entries])
        number = np.broadcast_to(np.arange(k), (k, k))
        self.lists = np.lexsort((number, gaps), axis=1)
        self.gaps = np.take_along_axis(gaps, self.lists, axis=1)

    def nearest(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Nearest entry of each row (ties: lower index) and its squared distance."""
        n, k = len(x), len(self.entries)
        first = np.arange(0, k, max(1, int(k ** 0.5)))
        away = np.stack([((x - self.entries[e]) ** 2).sum(axis=1) for e in first], axis=1)
        pick = away.argmin(axis=1)
        at, best = first[pick], away[np.arange(n), pick]
        marked = np.zeros((n, k), bool)
        marked[:, first] = True
        place = np.zeros(n, np.int64)
        live = np.arange(n)
        while len(live):
            here = at[live]
            step = place[live][:, None] + np.arange(self.stretch)
            within = np.minimum(step, k - 1)
            entry = self.lists[here[:, None], within]
            reach = (step < k) & (self.gaps[here[:, None], within] <= 4 * best[live][:, None])
            row, col = np.nonzero(reach & ~marked[live[:, None], entry])
            tested = entry[row, col]
            marked[live[row], tested] = True
            apart = x[live[row]] - self.entries[tested]
            found = np.full(entry.shape, FAR)
            found[row, col] = np.einsum("ij,ij->i", apart, apart)
            least = found.min(axis=1)
            who = np.where(found == least[:, None], entry, k).min(axis=1)
            better = (least < best[live]) | ((least == best[live]) & (who < here))
            moved = live[better]
            at[moved], best[moved], place[moved] = who[better], least[better], 0
            place[live[~better]] += self.stretch
            live = live[better | (reach[:, -1] & (step[:, -1] < k - 1))]
        return at, best


def cuts(dimension: int, parts: int) -> list[slice]:
    edge = [i * dimension // parts for i in range(parts + 1)]
    return [slice(a, b) for a, b in zip(edge, edge[1:])]


def integer_vectors(rows: DataFrame, id_col: str, vector_col: str, group_col: str, p: CodeParams) -> DataFrame:
    """(id, grp, v): the rows kept, with integer components."""
    x = F.col(vector_col)
    bad = F.exists(x, lambda e: e.isNull() | F.isnan(e) | (F.abs(e) == float("inf")))
    whole = F.transform(x, lambda e: F.floor(F.greatest(F.least(e.cast("double") * p.scale, F.lit(float(LIMIT))),
                                                        F.lit(float(-LIMIT)))).cast("int"))
    return rows.where(x.isNotNull() & ~bad).select(F.col(id_col).alias("id"), F.col(group_col).alias("grp"), whole.alias("v"))


def _matrix(column: pa.ListArray, dimension: int) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).astype(np.int64).reshape(len(column), dimension)


def _batches(batches, books, p: CodeParams):
    """(record batch, matrix, [(nearest, squared distance) of each part]) in bounded pieces."""
    dimension = sum(b.shape[1] for b in books)
    orchards = [Orchard(b, p.stretch) for b in books]
    for batch in batches:
        for start in range(0, batch.num_rows, p.rows):
            piece = batch.slice(start, p.rows)
            x = _matrix(piece.column(piece.schema.get_field_index("v")), dimension)
            yield piece, x, [o.nearest(x[:, c]) for o, c in zip(orchards, cuts(dimension, p.parts))]


def moved(vectors: DataFrame, books: list[np.ndarray], p: CodeParams) -> list[np.ndarray]:
    """The codebooks after one round: entries become the floors of their parts' means; unused ones stay."""
    dimension = sum(b.shape[1] for b in books)

    def sums(batches):
        total = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
        for _, x, found in _batches(batches, books, p):
            for t, c, (at, _) in zip(total, cuts(dimension, p.parts), found):
                order = np.argsort(at, kind="stable")
                used, first = np.unique(at[order], return_index=True)
                t[used, 0] += np.diff(np.append(first, len(at)))
                if t.shape[1] > 1:
                    t[used, 1:] += np.add.reduceat(x[order][:, c], first, axis=0)
        for part, t in enumerate(total):
            entry, place = np.nonzero(t[:, :1] > 0 + np.zeros_like(t))
            if len(entry):
                yield pa.RecordBatch.from_pydict({"part": pa.array(np.full(len(entry), part), pa.int32()),
                                                  "entry": pa.array(entry, pa.int32()), "place": pa.array(place, pa.int32()),
                                                  "total": pa.array(t[entry, place], pa.int64())})

    rows = (vectors.select("v").mapInArrow(sums, "part int, entry int, place int, total long")
            .groupBy("part", "entry", "place").agg(F.sum("total").alias("total")).toArrow())  # entries * (dimension + parts)
    total = [np.zeros((len(b), b.shape[1] + 1), np.int64) for b in books]
    part, entry, place, value = (rows.column(c).to_numpy() for c in ("part", "entry", "place", "total"))
    for i, t in enumerate(total):
        mine = part == i
        t[entry[mine], place[mine]] = value[mine]
    return [np.where(t[:, :1] > 0, t[:, 1:] // np.maximum(t[:, :1], 1), b) for b, t in zip(books, total)]


def train(vectors: DataFrame, p: CodeParams = CodeParams()) -> list[np.ndarray]:
    """The codebooks: the parts of the rows with the smallest ids, moved ``rounds`` times."""
    first = vectors.orderBy(F.asc_nulls_last("id"), "v").limit(p.entries).select("v").toArrow()
    seeds = first.column("v").to_pylist()
    if not seeds:
        return []
    same = np.array([s for s in seeds if len(s) == len(seeds[0])], np.int64).reshape(-1, len(seeds[0]))
    books = [same[:, c] for c in cuts(same.shape[1], p.parts)]
    vectors = vectors.where(F.size("v") == same.shape[1])
    for _ in range(p.rounds):
        books = moved(vectors, books, p)
    return books


def digest(books: list[np.ndarray]) -> str:
    return hashlib.sha256(",".join(str(x) for b in books for x in b.ravel().tolist()).encode()).hexdigest()


def encode(vectors: DataFrame, books: list[np.ndarray], p: CodeParams = CodeParams()) -> DataFrame:
    """(id, grp, code, error) of the vectors with the codebooks' dimension."""
    dimension = sum(b.shape[1] for b in books)
    digits = max(2, len(f"{max((len(b) for b in books), default=1) - 1:x}"))
    out = vectors.select("id", "grp").schema.add("code", "string").add("error", "long")

    def run(batches):
        for piece, _, found in _batches(batches, books, p):
            codes = ["".join(f"{i:0{digits}x}" for i in row) for row in zip(*(at.tolist() for at, _ in found))]
            yield pa.RecordBatch.from_arrays(
                [piece.column(0), piece.column(1), pa.array(codes, pa.string()),
                 pa.array(sum(d for _, d in found), pa.int64())], names=["id", "grp", "code", "error"])

    return vectors.where(F.size("v") == dimension).mapInArrow(run, out)


def decode(codes: DataFrame, books: list[np.ndarray]) -> DataFrame:
    """(id, approximation): the entries that a code names, as integer components."""
    digits = max(2, len(f"{max((len(b) for b in books), default=1) - 1:x}"))
    out = codes.select("id").schema.add("approximation", ArrayType(LongType()))

    def run(batches):
        for batch in batches:
            code = batch.column(1).to_pylist()
            number = [[int(c[i * digits:(i + 1) * digits], 16) for i in range(len(books))] for c in code]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array([np.concatenate([b[i] for b, i in zip(books, row)]) for row in number],
                                           pa.list_(pa.int64()))], names=["id", "approximation"])

    return codes.select("id", "code").mapInArrow(run, out)


def op11_orchard_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = CodeParams()
    vectors = stored(integer_vectors(read_table(spark, sf_dir, "embeddings"), "vec_id", "embedding", "label", p), "codes-vectors")
    books = train(vectors, p)
    if not books:
        return vectors.select(F.col("id").alias("vec_id"), F.lit("").alias("code"), F.lit(0).cast("long").alias("error"),
                              F.lit(0).cast("long").alias("label_error"), F.lit("").alias("codebooks_sha256"))
    coded = stored(encode(vectors, books, p), "codes")
    # a group's sum is copied to `salts` keys, so that the rows of a hot group meet it in as many tasks
    salt = F.explode(F.sequence(F.lit(0), F.lit(p.salts - 1)))
    sums = coded.groupBy("grp").agg(F.sum("error").alias("label_error")).withColumn("salt", salt)
    rows = coded.withColumn("salt", F.pmod(F.xxhash64("id", "code"), F.lit(p.salts)).cast("int")).alias("c")
    joined = rows.join(sums.alias("s"), F.col("c.grp").eqNullSafe(F.col("s.grp")) & (F.col("c.salt") == F.col("s.salt")))
    return joined.select(F.col("id").alias("vec_id"), "code", "error", "label_error", F.lit(digest(books)).alias("codebooks_sha256"))


def _oracle(rounds: int = CodeParams.rounds) -> str:
    """Every part against every entry, round by round."""
    steps = []
    for r in range(rounds + 1):
        steps.append(f"""
a{r} AS MATERIALIZED (
  SELECT vec_id, part, arg_min(entry, gap * 256 + entry) AS entry, min(gap) AS gap
  FROM (SELECT x.vec_id, x.part, c.entry, sum((x.v - c.v) * (x.v - c.v)) AS gap
        FROM x JOIN c{r} c ON x.part = c.part AND x.pos = c.pos GROUP BY ALL) GROUP BY vec_id, part)""")
        if r < rounds:
            steps.append(f"""
c{r + 1} AS MATERIALIZED (
  SELECT c.part, c.entry, c.pos, coalesce(m.v, c.v) AS v
  FROM c{r} c LEFT JOIN (
    SELECT x.part, a.entry, x.pos, CAST(floor(sum(x.v) / count(*)) AS BIGINT) AS v
    FROM x JOIN a{r} a ON a.vec_id = x.vec_id AND a.part = x.part GROUP BY ALL) m
    ON m.part = c.part AND m.entry = c.entry AND m.pos = c.pos)""")
    return f"""
WITH kept AS MATERIALIZED (
  SELECT vec_id, label, embedding, len(embedding) // 4 AS width FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda e: e IS NULL OR NOT isfinite(e))) = 0),
x AS MATERIALIZED (
  SELECT vec_id, (i - 1) // width AS part, (i - 1) % width AS pos, CAST(floor(1024 * CAST(e AS DOUBLE)) AS BIGINT) AS v
  FROM (SELECT vec_id, width, unnest(embedding) AS e, generate_subscripts(embedding, 1) AS i FROM kept)),
seeds AS (SELECT vec_id, row_number() OVER (ORDER BY vec_id) - 1 AS entry FROM kept QUALIFY entry < 256),
c0 AS MATERIALIZED (SELECT part, entry, pos, v FROM x JOIN seeds USING (vec_id)),{",".join(steps)},
coded AS (SELECT vec_id, string_agg(printf('%02x', entry), '' ORDER BY part) AS code, CAST(sum(gap) AS BIGINT) AS error
          FROM a{rounds} GROUP BY vec_id)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error,
       (SELECT sha256(string_agg(v, ',' ORDER BY part, entry, pos)) FROM c{rounds}) AS codebooks_sha256
FROM coded JOIN kept USING (vec_id)
"""


ORACLE_SQL = _oracle()
