import random

from tests.conftest import SF0001
from tests.llm.brute import near_components
from stride.llm.near_dedup import NearParams, components, near_dedup_stage, near_duplicates, op5_near_dedup


def got(df):
    return {r.doc_id: (r.n_shingles, r.component_id) for r in df.collect()}


def test_edge_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, " \t\n"), (4, "a b"), (5, "A b"), (6, "a"), (7, "a b c d"), (8, "A  B\tC D"),
            (8, "A  B\tC D"), (None, "a b"), (9, "x y z w")]
    out = sorted((str(r.doc_id), r.n_shingles, r.component_id, r.kept)
                 for r in near_duplicates(docs(rows), NearParams(words=3, percent=85)).collect())
    assert out == sorted([("1", 0, 1, True), ("2", 0, 2, True), ("3", 0, 3, True), ("4", 1, 4, True), ("5", 1, 4, False),
                          ("6", 1, 6, True), ("7", 2, 7, True), ("8", 2, 7, False), ("8", 2, 7, False),
                          ("None", 1, None, True), ("9", 2, 9, True)])


def test_texts_of_one_document_join_their_groups(docs):
    """Document 7 has a text like 3's and another like 5's: all are one group."""
    one, two = (" ".join(f"{x}{i}" for i in range(40)) for x in "ab")
    got_ = {r.component_id for r in near_duplicates(docs([(3, one), (5, two), (7, one), (7, two + " z"), (9, two)])).collect()}
    assert got_ == {3}


def test_empty_table(spark, docs):
    assert near_duplicates(docs([])).collect() == []


def edited(rnd, words, k):
    words = list(words)
    for _ in range(k):
        i, what = rnd.randrange(len(words)), rnd.random()
        if what < 0.6:
            words[i] = f"w{rnd.randrange(10 ** 6)}"
        elif what < 0.8:
            words.insert(i, f"w{rnd.randrange(10 ** 6)}")
        else:
            words.pop(i)
    return words


def test_groups_of_edited_copies_equal_brute_force(docs):
    """Copies with few and many edits of one original, with and without it, beside a line that all share."""
    rnd = random.Random(11)
    rows = []
    for group, (size, copies) in enumerate([(60, 60), (150, 80), (400, 25), (900, 12)]):
        original = [f"g{group}v{rnd.randrange(400)}" for _ in range(size)]
        if group != 1:
            rows.append(original)
        rows += [edited(rnd, original, rnd.randrange(1 + size // 15)) for _ in range(copies)]
    shared = [f"s{i}" for i in range(30)]
    rows += [shared + [f"u{rnd.randrange(10 ** 7)}" for _ in range(rnd.randrange(2, 60))] for _ in range(60)]
    rnd.shuffle(rows)
    table = [(i, " ".join(w)) for i, w in enumerate(rows)]
    for p in (NearParams(words=3, percent=85), NearParams()):
        assert got(near_duplicates(docs(table), p)) == near_components(table, p.words, p.percent)


def test_query_equals_brute_force(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF0001}/documents.parquet").select("doc_id", "text").collect()]
    assert got(op5_near_dedup(spark, SF0001)) == near_components(rows, 3, 85)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(1, 40)] + [(100, 90)], "a long, b long")
    assert {tuple(r) for r in components(links).collect()} == {(i, 1) for i in range(1, 41)} | {(90, 90), (100, 90)}


def test_stage_keeps_one_of_each_group(spark, docs):
    text = " ".join(f"w{i}" for i in range(50))
    table = docs([(3, text), (1, text), (2, text + " more"), (4, "other words here altogether now"), (None, text), (5, None)])
    out = near_dedup_stage(spark, table, "")
    assert out.columns == table.columns
    assert sorted(str(r.doc_id) for r in out.collect()) == ["1", "4", "5", "None"]
