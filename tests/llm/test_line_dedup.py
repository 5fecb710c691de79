import random

import corpus_pipeline
import duckdb
from pyspark.sql import functions as F

from tests.conftest import SF0001
from stride.llm import line_dedup
from stride.llm.line_dedup import (LineParams, banded_distance, dropped_lines, letter_counts, letters_differ, line_dedup_stage,
                                   listed_keys, op4_line_dedup, pieces_found, probed_keys)


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        new = [i]
        for j, y in enumerate(b, 1):
            new.append(min(row[j] + 1, new[-1] + 1, row[j - 1] + (x != y)))
        row = new
    return row[-1]


def edit(rnd, s, k):
    s = list(s)
    for _ in range(k):
        what, i = rnd.random(), rnd.randint(0, len(s))
        if what < 0.35:
            s.insert(i, rnd.choice("abé😀"))
        elif what < 0.7 and s:
            s.pop(min(i, len(s) - 1))
        elif s:
            s[min(i, len(s) - 1)] = rnd.choice("abé😀")
    return "".join(s)


def pairs(t, n=600):
    rnd, out = random.Random(t), []
    while len(out) < n:
        a = "".join(rnd.choice("abé😀") for _ in range(rnd.randint(t + 1, 14)))
        b = edit(rnd, a, rnd.randint(0, t + 2))
        a, b = sorted((a, b), key=len)
        if len(b) - len(a) <= t < len(a):
            out.append((a, b, distance(a, b)))
    return out


def test_distance_segments_and_filter(spark):
    """For thresholds 1 to 3: the banded distance is exact up to the threshold, and no pair within it is missed."""
    for t in (1, 2, 3):
        p = LineParams(threshold=t)
        a, b = F.col("a"), F.col("b")
        df = spark.createDataFrame(pairs(t), "a string, b string, d int").select(
            "a", "b", "d", banded_distance(F.split(a, ""), F.split(b, ""), t).alias("got"),
            F.size(F.array_intersect(listed_keys(a, F.length(a), t), probed_keys(b, F.length(b), t))).alias("hits"),
            pieces_found(a, F.length(a), b, 8, t).alias("pieces"),
            letters_differ(letter_counts(a, p), letter_counts(b, p), p).alias("letters"))
        for r in df.collect():
            assert min(r.got, t + 1) == min(r.d, t + 1), r
            if r.d <= t:
                assert r.hits > 0 and r.letters <= 2 * t and r.pieces >= 8 - t, r


LINE = "This is a line of more than forty characters, no doubt."
NEAR = LINE.replace("doubt", "doubts")
FAR = LINE.replace("more", "fewer")


def test_rows_that_go(spark, docs):
    rows = [(5, f"short\n{LINE}"), (2, f"{LINE}\nshort\nshort"), (7, f"{NEAR}\n{FAR}\n{FAR}"), (8, None), (9, ""),
            (None, LINE), (10, "\n\n"), (7, f"{NEAR}\n{FAR}\n{FAR}")]
    got = {(r.doc_id, tuple(r.dropped)) for r in dropped_lines(docs(rows)).collect()}
    assert got == {(2, (2,)), (5, (0, 1)), (7, (0, 2)), (None, (0,))}
    out = line_dedup_stage(spark, docs(rows), "")
    assert out.columns == docs(rows).columns
    want = [(2, f"{LINE}\nshort", len(LINE) + 6), (7, FAR, len(FAR)), (7, FAR, len(FAR)), (8, None, 0), (9, "", 0), (10, "\n\n", 2)]
    assert sorted(str((r.doc_id, r.text, r.n_chars)) for r in out.collect()) == sorted(map(str, want))


def test_first_is_by_document_then_its_place_there(spark, docs):
    """Document 1 has X before its near line Y; that document 9 has Y at its top makes Y no earlier."""
    got = {(r.doc_id, tuple(r.dropped)) for r in dropped_lines(docs([(1, f"{LINE}\n\n\n{NEAR}"), (9, NEAR)])).collect()}
    assert got == {(1, (3,)), (9, (0,))}


def test_empty_table(spark, docs):
    assert dropped_lines(docs([])).collect() == []
    assert line_dedup_stage(spark, docs([]), "").collect() == []


def test_query_equals_its_sql(spark):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM read_parquet('{SF0001}/documents.parquet')")
    want = sorted(con.execute(line_dedup.ORACLE_SQL).fetchall())
    assert sorted(tuple(r) for r in op4_line_dedup(spark, SF0001).collect()) == want


def test_pipeline_drops_short_lines_and_whole_copies(spark, docs):
    """Equal lines of any length go in the pipeline, so an exact copy leaves no stub; blank lines stay, edits need 40 characters."""
    stage = dict(corpus_pipeline.STAGES)["line_dedup"]
    text = f"Title\n\n\n{LINE}\nAll rights reserved."
    rows = [(1, text), (2, text), (3, f"Other title\n\nAll rights reserved.\n{NEAR}"), (4, "Titles\n \n\t\nTitle"), (5, "\n \n")]
    got = sorted((r.doc_id, r.text, r.n_chars) for r in stage(spark, docs(rows), "").collect())
    want = [(1, text), (3, "Other title\n"), (4, "Titles\n \n\t"), (5, "\n \n")]
    assert got == [(i, t, len(t)) for i, t in want]
