import functools
import zlib

import numpy as np

from tests.conftest import SF001
from stride.llm.language import LanguageParams, grams, identify, learn, lower, op10_language, viterbi


def plain(score, switch):
    value = np.zeros(score.shape[1])
    for row in score:
        value = np.maximum(value, value.max() - switch) + row
    return value.max()


def test_viterbi_is_exact():
    rnd = np.random.default_rng(3)
    for _ in range(40):
        lengths = rnd.integers(1, 700, rnd.integers(1, 6))
        doc = np.repeat(np.arange(len(lengths)), lengths)
        score = rnd.normal(0, 3, (len(doc), rnd.integers(1, 5)))
        path = viterbi(score, doc, 4.0)
        for d in range(len(lengths)):
            s, g = score[doc == d], path[doc == d]
            got = s[np.arange(len(g)), g].sum() - 4.0 * (g[1:] != g[:-1]).sum()
            assert abs(got - plain(s, 4.0)) < 1e-6


TRAIN = [(1, "the house and the garden of the king", "en"), (2, "le jardin et la maison du roi", "fr"),
         (3, "дом и сад короля", "ru"), (4, "the river and the sea", "en"), (5, "la mer et le fleuve", "fr"), (6, "x y", None)]


def test_spans_scripts_and_edges(spark):
    model = learn(spark.createDataFrame(TRAIN, "doc_id long, text string, lang string"))
    assert model.names == ["en", "fr", "ru"]
    rows = [(1, "the king and the sea of the garden house le jardin et la maison du roi et le fleuve"), (2, None), (3, ""),
            (4, "12 34 !! 😀😀"), (5, "сад"), (5, "сад"), (None, "the garden")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = identify(df, model, LanguageParams(switch=4.0)).collect()
    by = {r.doc_id: r for r in got}
    assert len(got) == 7 and [s.lang for s in by[1].spans] == ["en", "fr"]
    assert rows[0][1][by[1].spans[1].begin:].startswith("le jardin")
    assert all((by[i].lang_pred, by[i].score, by[i].spans) == ("und", 0.0, []) for i in (2, 3, 4))
    assert (by[5].lang_pred, by[5].score) == ("ru", 1.0) and by[None].lang_pred == "en"
    nothing = learn(spark.createDataFrame([], "doc_id long, text string, lang string"))
    assert {r.lang_pred for r in identify(df, nothing).collect()} == {"und"}
    assert identify(df.limit(0), model).collect() == []


def mix(x):
    m = 2 ** 64 - 1
    x ^= x >> 30
    x = x * 0xBF58476D1CE4E5B9 & m
    x ^= x >> 27
    x = x * 0x94D049BB133111EB & m
    return x ^ x >> 31


def test_grams_and_counts_equal_plain(spark):
    """The buckets of each word, and the learned log probabilities, from loops over its letters."""
    texts = ["The straße, naïve 2x!", "", "дом\nЁлка", "a 中文 b"]

    def plain(text):
        out, word = [], ""
        for c in lower(text) + " ":
            if c.isalpha():
                word += c
            elif word:
                codes = [0, *map(ord, word), 0]
                out.append(sorted([mix(c + (1 << 40)) >> 48 for c in codes[1:-1]]
                                  + [mix(functools.reduce(lambda a, c: (a * 0x110001 + c) % 2 ** 64, codes[i:i + n], n << 40)) >> 48
                                     for n in (2, 3) for i in range(len(codes) - n + 1)]))
                word = ""
        return out

    text, _, _, _, owner, bucket = grams(texts)
    got = [[] for _ in texts]
    for w in range(len(text)):
        got[text[w]].append(sorted(bucket[owner == w].tolist()))
    assert got == [plain(t) for t in texts]
    p = LanguageParams()
    model = learn(spark.createDataFrame(TRAIN, "doc_id long, text string, lang string"))
    counts = np.zeros((1 << 16, 3))
    for _, t, lang in TRAIN:
        if lang:
            for w in plain(t):
                for b in w:
                    counts[b, model.names.index(lang)] += 1
    want = np.log((counts + p.smooth) / (counts.sum(axis=0) + p.smooth * (1 << 16)))
    assert np.allclose(model.score, want - want.mean(axis=1, keepdims=True))


def test_letters_of_every_plane_and_places(spark):
    model = learn(spark.createDataFrame(TRAIN, "doc_id long, text string, lang string"))
    rows = [(1, "😀 👍🏽"), (2, "𝒜𝒷"), (3, "İİİ the king and the sea of the garden house le jardin et la maison du roi et le fleuve"),
            (4, "the garden " * 20000)]
    by = {r.doc_id: r for r in identify(spark.createDataFrame(rows, "doc_id long, text string"), model, LanguageParams(switch=4.0)).collect()}
    assert by[1].lang_pred == "und" and by[2].lang_pred != "und"
    assert rows[2][1][by[3].spans[-1].begin:].startswith("le jardin")  # a letter whose lower case is longer moves nothing
    assert by[4].lang_pred == "en" and len(by[4].spans) == 1


def test_held_out_accuracy(spark):
    truth = {r.doc_id: r.lang for r in spark.read.parquet(f"{SF001}/documents.parquet").collect()}
    rows = op10_language(spark, SF001).collect()
    assert len(rows) == len(truth)
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)
    held = [r for r in rows if r.held_out]
    assert sum(r.lang_pred == truth[r.doc_id] for r in held) >= 0.97 * len(held)
    assert all(0 <= r.score <= 1 for r in rows)
