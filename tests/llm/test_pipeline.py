import __spark_entry__ as E
import corpus_pipeline
from tests.conftest import SF0001
from tests.llm.brute import near_components, shingles
from stride.llm.common import read_table, stored


def test_stages_each_on_their_own_input(spark):
    docs = read_table(spark, SF0001, "documents")
    columns = docs.columns
    seen = []
    for name, stage in corpus_pipeline.STAGES:
        out = stored(stage(spark, docs, SF0001), f"test-{name}")
        before, after = docs.collect(), out.collect()
        seen.append((name, len(before), len(after)))
        if name != "bpe":
            assert out.columns == columns
            texts = {r.doc_id: r.text for r in before}
            assert {r.doc_id for r in after} <= set(texts) and len(after) == len({r.doc_id for r in after})
        if name == "line_dedup":
            lines = [x for r in after for x in (r.text or "").split("\n") if x.strip(" \t\r\x0b\x0c")]
            assert len(lines) == len(set(lines))
            assert all(r.n_chars == len(r.text or "") for r in after)
        if name == "near_dedup":
            want = near_components([(r.doc_id, r.text) for r in before], 5, 80)
            assert {r.doc_id for r in after} == {i for i, (_, c) in want.items() if i == c}
        if name == "decontamination":
            bench = [shingles(r.text, 5) for r in read_table(spark, SF0001, "benchmark").collect()]
            leaky = {r.doc_id for r in before if any(len(s & shingles(r.text, 5)) >= 0.8 * len(s) for s in bench)}
            assert {r.doc_id for r in after} == {r.doc_id for r in before} - leaky
        docs = out
    assert [n for n, _, _ in seen] == ["toxicity", "line_dedup", "near_dedup", "decontamination", "bpe"]
    run = corpus_pipeline.run(spark, SF0001)
    assert sorted(map(tuple, run.collect())) == sorted(map(tuple, docs.collect()))


def test_registered_queries():
    names = list(E.queries())
    assert [sum(n.startswith(f"op{i}_") for n in names) for i in range(1, 14)] == [1] * 13 and "pipeline" in names


def test_empty_documents_pass_through(spark, docs, tables):
    folder = tables(documents=docs([]), labels=spark.createDataFrame([], "doc_id long, quality int, toxic int"),
                    benchmark=spark.createDataFrame([], "item_id long, text string"))
    assert corpus_pipeline.run(spark, folder).collect() == []
