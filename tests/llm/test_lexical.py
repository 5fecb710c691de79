"""Ranking against a plain scorer; pair bounds read less than single bounds and lose nothing."""
import math
import random
import re

import numpy as np
import pytest

from stride.llm import lexical as L
from stride.llm.registry import ORACLE, QUERIES
from tests.conftest import SF001

TERM = re.compile("[^\x00-\x2f\x3a-\x40\x5b-\x60\x7b-\x7f]+")


def terms(text):
    return TERM.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))


def plain(docs, items, top=10):
    """{(item_id, rank): (doc_id, score)}"""
    held = [(i, terms(t)) for i, t in docs]
    held = [(i, t) for i, t in held if t]
    n_docs, n_terms = len(held), sum(len(t) for _, t in held)
    df = {}
    for _, t in held:
        for x in set(t):
            df[x] = df.get(x, 0) + 1
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, set()).update(terms(t))
    out = {}
    for item, query in wanted.items():
        scores = []
        for doc, t in held:
            m = 10 + (90 * len(t) * n_docs) // n_terms
            s = 0
            for x in query & set(t):
                tf = t.count(x)
                s += math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[x] + 1))) * ((10 ** 9 * tf) // (1000 * tf + 8 * m))
            if s > 0:
                scores.append((-s, doc is None, doc or 0, doc))
        for rank, (s, _, _, doc) in enumerate(sorted(scores)[:top], 1):
            out[item, rank] = (doc, -s)
    return out


def ask(spark, docs, items):
    d = spark.createDataFrame([(i, t, 1, 2, "x") for i, t in docs], "doc_id long, text string, n long, score long, term string")
    b = spark.createDataFrame([(i, t, 1, "x") for i, t in items], "item_id long, text string, rank int, key string")
    return d, b


def test_against_plain(spark):
    rng = random.Random(2)
    words = [f"w{i}" for i in range(60)] + ["Été", "été", "a’b", "X9", "\U0001f600"]
    pick = lambda n: " ".join(words[min(int(rng.expovariate(0.08)), 64)] for _ in range(n))
    docs = [(i, pick(rng.randrange(1, 60))) for i in range(400)]
    docs += [(1000 + i, docs[i][1]) for i in range(40)] + [(5, docs[5][1]), (None, docs[5][1]), (2000, None), (2001, " .,;"), (2002, pick(20000))]
    items = [(i, pick(rng.randrange(1, 30))) for i in range(30)] + [(3, "w1 unheard"), (None, "w2 w3"), (40, None), (41, "unheard"), (42, "")]
    d, b = ask(spark, docs, items)
    got = {(r.item_id, r.rank): (r.doc_id, r.score) for r in L.ranked(d.repartition(5), b, L.SearchParams(shard_items=11)).collect()}
    assert got == plain(docs, items)


@pytest.mark.parametrize("docs,items", [([], [(1, "a")]), ([(1, "a")], []), ([(1, None)], [(1, "a")]), ([(1, "a b")], [(1, None)])])
def test_empty(spark, docs, items):
    assert L.ranked(*ask(spark, docs, items)).count() == 0


def test_pair_bounds_skip_more_and_lose_nothing(spark):
    docs = spark.read.parquet(f"{SF001}/documents.parquet")
    items = spark.read.parquet(f"{SF001}/benchmark.parquet")
    (q,) = list(L.item_shards(items, L.SearchParams()))
    sent = spark.sparkContext.broadcast(q)
    listed = L.postings(docs, sent).toPandas()
    df = np.bincount(np.concatenate(listed["terms"].to_list()).astype(int), minlength=len(q.vocabulary))
    q.weigh(df, len(listed), int(listed["n"].sum()))
    import pyarrow as pa
    rows = pa.RecordBatch.from_arrays([pa.array(listed["doc_id"]), pa.array(listed["n"]), pa.array(listed["terms"].to_list(), pa.list_(pa.int32())),
                                       pa.array(listed["tfs"].to_list(), pa.list_(pa.int32()))], names=["doc_id", "n", "terms", "tfs"])
    found, read = [], []
    for pair_bounds in (True, False):
        best, total = L.Best(len(q.ids), 10), 0
        for at in range(0, len(listed), 100):
            block = {k: v[0].values.to_numpy() for k, v in L._block(rows.slice(at, 100), q).items()}
            total += L.search_block(block, q, best, pair_bounds)
        found.append([(s.tolist(), d.tolist()) for s, d in zip(best.score, best.doc)])
        read.append(total)
    assert found[0] == found[1]
    assert read[0] < read[1]


def test_query_equals_sql(spark):
    import duckdb
    con = duckdb.connect()
    for t in ("documents", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    assert sorted(map(tuple, QUERIES["op13_lexical_search"](spark, SF001).collect())) == sorted(con.execute(ORACLE["op13_lexical_search"]).fetchall())
