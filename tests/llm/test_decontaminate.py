import random

import numpy as np

from tests.conftest import SF0001
from tests.llm.brute import shingles
from stride.llm.common import read_table
from stride.llm.decontaminate import LeakParams, decontaminate_stage, leaks, op2_decontaminate, shards, split_item

ITEM = "item_id long, text string"


def items(spark, texts):
    return spark.createDataFrame([(i, t) for i, t in enumerate(texts)], ITEM)


def sentence(rnd, n, vocabulary=3000):
    return " ".join(f"w{rnd.randrange(vocabulary)}" for _ in range(n)).capitalize()


def test_split_item():
    assert split_item("What is it? A thing.") == ("What is it?", "A thing.")
    assert split_item("one two three four five six") == ("one two three four", "five six")
    assert split_item("") == ("", "")


def test_planted_passages(spark, docs):
    rnd = random.Random(3)
    bench = [f"{sentence(rnd, 20)}. {sentence(rnd, rnd.randrange(1, 12))}." for _ in range(60)]
    clean = [(i, f"{sentence(rnd, 300)}.") for i in range(40)]
    leaky = [(100 + i, f"{sentence(rnd, rnd.randrange(200))} {b} {sentence(rnd, rnd.randrange(200))}") for i, b in enumerate(bench)]
    half = [(200 + i, f"{sentence(rnd, 50)} {b.split('. ')[0]}. {sentence(rnd, 50)}") for i, b in enumerate(bench)]
    shouted = [(300, bench[0].upper().replace(".", " !"))]
    table = docs(clean + leaky + half + shouted + [(400, None), (401, ""), (None, bench[1])])
    got = {(r.doc_id, r.item_id) for r in leaks(table, items(spark, bench)).collect()}
    assert got == {(100 + i, i) for i in range(60)} | {(300, 0), (None, 1)}
    kept = decontaminate_stage_of(spark, table, items(spark, bench))
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(map(str, [*range(40), *range(200, 260), 400, 401]))
    assert kept.columns == table.columns
    # several shards find the same
    few = LeakParams(shard_items=17)
    assert {(r.doc_id, r.item_id) for r in leaks(table, items(spark, bench), few).collect()} == got


def test_one_changed_word_in_a_short_answer(spark, docs):
    rnd = random.Random(8)
    bench = [f"{sentence(rnd, 30)}? {sentence(rnd, rnd.randrange(3, 9))}." for _ in range(30)]
    edited = []
    for i, b in enumerate(bench):
        question, answer = b.split("? ")
        words = answer.split()
        words[rnd.randrange(len(words))] = "other"
        edited.append((i, f"{sentence(rnd, 40)}. {question}? {' '.join(words)} {sentence(rnd, 40)}"))
    without = [(100 + i, f"{sentence(rnd, 40)}. {b.split('? ')[0]}? {sentence(rnd, 40)}") for i, b in enumerate(bench)]
    long_text = [(900, f"{sentence(rnd, 30000)} {bench[3]} {sentence(rnd, 30000)}")]
    got = {(r.doc_id, r.item_id) for r in leaks(docs(edited + without + long_text), items(spark, bench)).collect()}
    assert {(i, i) for i in range(30)} | {(900, 3)} <= got and all(d < 100 or d == 900 for d, _ in got)


def decontaminate_stage_of(spark, table, bench):
    import tempfile
    folder = tempfile.mkdtemp(prefix="stride-test-")
    bench.write.parquet(f"{folder}/benchmark.parquet")
    return decontaminate_stage(spark, table, folder)


def test_block_max_retrieval_equals_exhaustive_bm25(spark):
    """Without verification: the passages' (item, score) above the threshold equal plain BM25 over all items."""
    rnd = random.Random(5)
    bench = [sentence(rnd, rnd.randrange(3, 30), 120) for _ in range(90)]
    p = LeakParams(threshold=0.4, overlap=0.0, part_overlap=0.0, short_part=0, block=4)
    (index,) = shards(items(spark, bench), p)
    s = index.stride
    texts = [sentence(rnd, rnd.randrange(1, 150), 120) for _ in range(50)] + [bench[4], f"{bench[7]} {bench[8]}"]
    got = {(d, i): round(sc, 9) for d, i, sc, *_ in index.leaks(texts)}
    words = [b.lower().split() for b in bench]
    mean = np.mean([len(w) for w in words])
    df = {t: sum(t in w for w in words) for w in words for t in w}

    def weight(t, w):
        tf = w.count(t)
        return np.log1p((len(words) - df[t] + 0.5) / (df[t] + 0.5)) * tf * (p.k1 + 1) / (
            tf + p.k1 * (1 - p.b + p.b * len(w) / mean))

    own = [sum(weight(t, w) for t in set(w)) for w in words]
    number = {index.ids[j]: j for j in range(len(bench))}
    want = {}
    for d, text in enumerate(texts):
        w = text.lower().split()
        for a in range(0, max(1, -(-(len(w) - s) // s)) * s, s):
            passage = set(w[a:a + 2 * s])
            for i, item in enumerate(words):
                sc = sum(weight(t, item) for t in passage if t in item) / own[i]
                if sc >= p.threshold:
                    want.setdefault((d, number[i]), []).append(round(sc, 9))
    assert set(got) == set(want)
    assert all(any(abs(got[k] - x) < 1e-8 for x in want[k]) for k in got)


def test_empty_benchmark_and_documents(spark, docs):
    assert leaks(docs([(1, "a b")]), items(spark, [])).collect() == []
    assert leaks(docs([]), items(spark, ["a b c"])).collect() == []
    assert leaks(docs([(1, "a b c")]), items(spark, [None, "", "!?"])).collect() == []


def test_query_equals_brute_force(spark):
    bench = {r.item_id: shingles(r.text, 5) for r in read_table(spark, SF0001, "benchmark").collect()}
    want = set()
    for r in read_table(spark, SF0001, "documents").collect():
        own = shingles(r.text, 5)
        want |= {(r.doc_id, i) for i, s in bench.items() if len(s & own) >= 0.8 * len(s)}
    got = {(r.doc_id, r.item_id) for r in op2_decontaminate(spark, SF0001).collect()}
    assert got == want
