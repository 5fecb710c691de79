import hashlib

import xxhash
from pyspark.sql import functions as F

from tests.conftest import SF0001
from stride.llm.fingerprint import LANE, SOFT, STRONG, combine, fingerprints, lanes_of, likeness, op6_fingerprint, to_text


def lanes(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "k long, t string")
    return {r.k: r.lanes for r in lanes_of(df, ["k"], "t").collect()}


def test_order_multiplicity_and_increments(spark):
    v = lanes(spark, ["a b\nc d\ne", "e\na b\nc d", "a b\nc d", "e", "a b\na b", "a b", "", "a  b\nc d\ne"])
    assert v[0] == v[1] and len({tuple(x) for x in v.values()}) == 7
    df = spark.createDataFrame([(v[2], v[3], v[0], v[4], v[5])], "ab array<long>, e array<long>, all array<long>, twice array<long>, once array<long>")
    r = df.select((combine(F.col("ab"), F.col("e")) == F.col("all")).alias("added"),
                  (combine(F.col("all"), F.col("e"), -1) == F.col("ab")).alias("taken"),
                  (combine(F.col("once"), F.col("once")) == F.col("twice")).alias("twice"),
                  likeness(F.col("all"), F.col("all")).alias("own"), to_text(F.col("all")).alias("t")).first()
    assert (r.added, r.taken, r.twice, r.own, len(r.t)) == (True, True, True, 1.0, 8 * 72)


MASK = 2 ** 64 - 1
P1, P2, P3, P4, P5 = (0x9E3779B185EBCA87, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0x85EBCA77C2B2AE63, 0x27D4EB2F165667C5)


def signed(x):
    return x - 2 ** 64 if x >= 2 ** 63 else x


def hash_of(*values):
    """Spark's xxhash64 of its arguments (text or long; null leaves the hash as it is)."""
    h = 42
    for v in values:
        if isinstance(v, str):
            h = xxhash.xxh64_intdigest(v.encode(), seed=h & MASK)
        elif isinstance(v, tuple):  # an int literal
            h = (h + P5 + 4) & MASK
            h ^= ((v[0] & 0xFFFFFFFF) * P1) & MASK
            h = (((h << 23 | h >> 41) & MASK) * P2 + P3) & MASK
            h = mix(h)
        elif v is not None:
            h = (h + P5 + 8) & MASK
            k = ((v & MASK) * P2) & MASK
            h ^= (((k << 31 | k >> 33) & MASK) * P1) & MASK
            h = (((h << 27 | h >> 37) & MASK) * P1 + P4) & MASK
            h = mix(h)
    return signed(h & MASK)


def mix(h):
    h ^= h >> 33
    h = (h * P2) & MASK
    h ^= h >> 29
    h = (h * P3) & MASK
    return h ^ (h >> 32)


def plain_lanes(text):
    """The lanes from the definition: paragraph hashes and the signs of word pairs, summed."""
    out = [0] * (STRONG + SOFT)
    for par in text.split("\n"):
        a, b = hash_of(par), hash_of("second", par)
        for i in range(STRONG):
            out[i] += hash_of(a, b, (i,)) & (LANE - 1)
        words = par.split(" ")
        for w, then in zip(words, [*words[1:], None]):
            h = hash_of(w, then) & MASK
            for i in range(SOFT):
                out[STRONG + i] += 1 if h >> i & 1 else -1
    return [x % LANE for x in out]


def test_lanes_are_recomputed(spark):
    texts = ["a b\nc d\ne", "", "one two two two", "é😀 x\n\nlast", " ".join(f"w{i}" for i in range(30_000))]
    got = lanes(spark, texts)
    for i, text in enumerate(texts):
        assert list(got[i]) == plain_lanes(text)


def check(rows, out):
    order = sorted(rows)
    for i, (d, t) in enumerate(order):
        then = order[(i + 1) % len(order)][1]
        edited = t[:len(t) - len(t) // 2] + then[:len(t) // 2]
        r = out[d]
        assert (r.n_chars, r.edited_sha256) == (len(t), hashlib.sha256(edited.encode()).hexdigest())
        assert 0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1
        assert (r.fingerprint == r.edited_fingerprint) == (r.near_edited == 1.0)


def test_query(spark):
    rows = [(r.doc_id, r.text or "") for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()]
    out = op6_fingerprint(spark, SF0001).collect()
    assert len(out) == len(rows)
    check(rows, {r.doc_id: r for r in out})
    prints = {}
    for r in out:
        prints.setdefault(dict(rows)[r.doc_id], set()).add(r.fingerprint)
    assert all(len(x) == 1 for x in prints.values())
    assert sum(r.near_edited > r.near_next for r in out) > 0.95 * len(out)


def test_edges(spark, docs):
    rows = [(1, None), (2, ""), (3, "é😀 x"), (5, "a"), (5, "a"), (None, "z")]
    out = fingerprints(docs(rows)).collect()
    assert sorted(str(r.doc_id) for r in out) == ["1", "2", "3", "5", "None"]
    by = {r.doc_id: r for r in out}
    assert by[1].fingerprint == by[2].fingerprint and by[1].near_next == 1.0
    assert by[3].n_chars == 4 and by[3].edited_sha256 == hashlib.sha256("é😀a".encode()).hexdigest()
    (one,) = fingerprints(docs([(9, "ab cd")])).collect()
    assert one.near_next == 1.0 and one.edited_sha256 == hashlib.sha256(b"ab ab").hexdigest()
    assert fingerprints(docs([])).collect() == []
