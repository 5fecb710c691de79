"""Orchard search against a full scan; codes against a plain k-means in Python integers."""
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from stride.llm import orchard as O
from stride.llm.registry import ORACLE, QUERIES
from tests.conftest import SF001

SCHEMA = "vec_id long, embedding array<float>, label int, code string, v int"


def plain(rows, p):
    """{vec_id: (code, error)} and the codebooks, entry by entry."""
    kept = sorted((i, [math.floor(p.scale * x) for x in e]) for i, e in rows
                  if e is not None and all(x is not None and math.isfinite(x) for x in e))
    width = len(kept[0][1]) // p.parts
    cut = lambda v, k: v[k * width:(k + 1) * width]
    books = [[cut(v, k) for _, v in kept[:p.entries]] for k in range(p.parts)]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, e)), n) for n, e in enumerate(book))

    for _ in range(p.rounds):
        for k in range(p.parts):
            groups = {}
            for _, v in kept:
                groups.setdefault(nearest(cut(v, k), books[k])[1], []).append(cut(v, k))
            for n, g in groups.items():
                books[k][n] = [sum(c) // len(g) for c in zip(*g)]
    found = {i: [nearest(cut(v, k), books[k]) for k in range(p.parts)] for i, v in kept}
    return {i: ("".join(f"{n:02x}" for _, n in f), sum(d for d, _ in f)) for i, f in found.items()}, books


@pytest.mark.parametrize("k,width,spread", [(256, 16, 900), (37, 3, 5), (2, 1, 2), (1, 4, 9), (64, 2, 1)])
def test_orchard_is_exact(k, width, spread):
    rng = np.random.default_rng(k)
    entries = rng.integers(-spread, spread + 1, (k, width))
    x = rng.integers(-spread, spread + 1, (400, width))
    x[:k] = entries[:400]  # rows that sit on an entry
    at, gap = O.Orchard(entries, 16).nearest(x)
    full = ((x[:, None, :] - entries[None]) ** 2).sum(axis=2)
    assert (gap == full.min(axis=1)).all()
    assert (at == full.argmin(axis=1)).all()  # argmin takes the lower index on ties


def test_codes_equal_plain_rounds(spark, tables):
    rng = np.random.default_rng(3)
    rows = [(int(i), rng.normal(size=8).astype(np.float32).tolist()) for i in rng.permutation(300)]
    rows += [(900, None), (901, [None] + [0.0] * 7), (902, [float("nan")] * 8), (903, [float("inf")] + [0.0] * 7),
             (904, rows[0][1]), (905, rows[0][1])]
    p = O.CodeParams()
    df = spark.createDataFrame([(i, e, None if i % 3 else i % 2, "x", 1) for i, e in rows], SCHEMA)
    got = QUERIES["op11_orchard_codes"](spark, tables(embeddings=df)).collect()
    want, books = plain(rows, p)
    assert {r.vec_id: (r.code, r.error) for r in got} == want
    sums = {}
    for r in got:
        label = None if r.vec_id % 3 else r.vec_id % 2
        sums[label] = sums.get(label, 0) + r.error
    assert all(r.label_error == sums[None if r.vec_id % 3 else r.vec_id % 2] for r in got)
    assert {r.codebooks_sha256 for r in got} == {O.digest([np.array(b) for b in books])}


def test_edges(spark, tables):
    empty = spark.createDataFrame([], SCHEMA)
    assert QUERIES["op11_orchard_codes"](spark, tables(embeddings=empty)).count() == 0
    p = O.CodeParams()
    rows = [(None, [9.0, 9.0, 9.0, 9.0, 9.0], 1, "x", 1), (5, [1.0, 2.0, 3.0, 4.0, 5.0], None, "x", 1),
            (5, [1.0, 2.0, 3.0, 4.0, 5.0], None, "x", 1), (6, [1.0], 2, "x", 1), (7, [1e30, 0.0, 0.0, 0.0, 0.0], 2, "x", 1)]
    vectors = O.integer_vectors(spark.createDataFrame(rows, SCHEMA), "vec_id", "embedding", "label", p)
    books = O.train(vectors, p)
    got = sorted(O.encode(vectors, books, p).collect(), key=lambda r: (r.id is None, r.id))
    assert [r.id for r in got] == [5, 5, 7, None]  # a vector of another length goes
    assert got[0].code == got[1].code == "00000000" and all(r.error == 0 for r in got)
    back = {r.id: r.approximation for r in O.decode(O.encode(vectors, books, p), books).collect()}
    assert back[5] == [1024, 2048, 3072, 4096, 5120] and back[7][0] == O.LIMIT


def test_query_equals_sql(spark):
    import duckdb
    con = duckdb.connect()
    con.execute(f"CREATE VIEW embeddings AS SELECT * FROM read_parquet('{SF001}/embeddings.parquet')")
    want = sorted(con.execute(ORACLE["op11_orchard_codes"]).fetchall())
    assert sorted(map(tuple, QUERIES["op11_orchard_codes"](spark, SF001).collect())) == want


def test_error_falls_with_rounds(spark):
    vectors = O.integer_vectors(spark.read.parquet(f"{SF001}/embeddings.parquet"), "vec_id", "embedding", "label", O.CodeParams())
    errors = []
    for rounds in (0, 4):
        p = O.CodeParams(rounds=rounds, entries=32)
        errors.append(O.encode(vectors, O.train(vectors, p), p).agg(F.sum("error")).first()[0])
    assert errors[1] < errors[0]
