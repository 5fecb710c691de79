import re

from tests.conftest import SF0001
from stride.llm.pii import KINDS, PiiParams, feistel, finds, luhn, only_digits, op3_pii, pseudonymise, pseudonyms, session_key

KEY = b"test key"
TEXTS = ["mail und.34@mail7.example.com x", "+1 (017) 555-7713", "97.51.17.173.", "4845168114407329", "4845 1681 1440 7329",
         "DE89 3704 0044 0532 0130 00", "born 1984-02-29, 3/4/1999, 12/31/2001 and 31.12.1999", "078-05-1120",
         "(212) 555-0100 or 212-555-0100 +44 20 7946 0958", "A+b@x.org"]


def test_feistel_permutes_and_reveals():
    for size in (1, 2, 3, 10, 97, 1000):
        image = [feistel(x, size, KEY, "t") for x in range(size)]
        assert sorted(image) == list(range(size))
        assert [feistel(y, size, KEY, "t", True) for y in image] == list(range(size))
    assert [feistel(x, 1000, KEY, "t") for x in range(9)] != [feistel(x, 1000, KEY, "u") for x in range(9)]


def test_formats_stay_and_values_come_back():
    for text in TEXTS:
        new, kinds = pseudonymise(text, KEY)
        assert kinds and new != text and len(pseudonymise(new, KEY)[1]) == len(kinds), text
        assert pseudonymise(new, KEY, True)[0] == text
    assert luhn(only_digits(pseudonymise(TEXTS[3], KEY)[0])) == 0
    # one value, two layouts: the same pseudonym
    assert only_digits(pseudonymise(TEXTS[3], KEY)[0]) == only_digits(pseudonymise(TEXTS[4], KEY)[0])
    assert pseudonymise("A+b@x.org", KEY)[0].lower() == pseudonymise("a+B@x.org", KEY)[0].lower()


def test_lookalikes_stay():
    for text in ["9807915762804490", "300.1.2.3", "1.2.3.4.5", "2001-02-30", "DE00 3704 0044 0532 0130 00", "000-12-3456",
                 "a@b", "version 1.2", "0000000000000000", "12345678", "31/31/2001", "order 4845168114407320"]:
        assert pseudonymise(text, KEY) == (text, []), text


def test_values_beside_other_groups():
    """A valid run of groups is found inside a longer run that is not valid as a whole."""
    for text, value in [("4111 1111 1111 1111 12/25", "4111 1111 1111 1111"), ("7 4111 1111 1111 1111", "4111 1111 1111 1111"),
                        ("call +12025550123 now", "+12025550123"), ("BE68 5390 0754 7034 VIA bank", "BE68 5390 0754 7034"),
                        ("4111 1111 1111 1111 5500 0000 0000 0004", "5500 0000 0000 0004")]:
        new, kinds = pseudonymise(text, KEY)
        assert kinds and value not in new and pseudonymise(new, KEY, True)[0] == text, text
    assert pseudonymise("BE68 5390 0754 7034", KEY)[1] == ["iban"] and pseudonymise("FR68 5390 0754 7034", KEY)[1] == []


def test_key_comes_from_the_session(spark, monkeypatch):
    drawn = session_key(spark)
    assert drawn == session_key(spark) and len(drawn) == 32
    monkeypatch.setenv("STRIDE_PII_KEY", "from the environment")
    assert session_key(spark) == b"from the environment"
    spark.conf.set("spark.stride.pii.key", "from the session")
    assert session_key(spark) == b"from the session"
    spark.conf.unset("spark.stride.pii.key")


def test_rows(spark, docs):
    rows = [(1, None), (2, ""), (3, TEXTS[0]), (3, TEXTS[0]), (None, TEXTS[3]), (4, "x" * 20000 + " 97.51.17.173")]
    out = pseudonyms(docs(rows), PiiParams(KEY)).collect()
    assert out[0].__fields__ == ["doc_id", "text", *[f"n_{k}" for k in KINDS]]
    by = {r.doc_id: r for r in out}
    assert len(out) == 6 and by[1].text is None and by[2].text == "" and by[3].n_email == 1 and by[None].n_card == 1
    assert by[4].n_ip == 1
    assert pseudonyms(docs([]), PiiParams(KEY)).collect() == []


def test_no_valid_value_is_left(spark):
    """Values found by plain searches and checked by plain rules do not stand in the pseudonymised texts."""
    def luhn_ok(d):
        odd, even = d[-1::-2], d[-2::-2]
        return (sum(map(int, odd)) + sum(sum(map(int, str(2 * int(c)))) for c in even)) % 10 == 0

    rows = spark.read.parquet(f"{SF0001}/documents.parquet").collect()
    seen = {"card": 0, "email": 0, "ip": 0}
    for r in rows:
        new = pseudonymise(r.text or "", KEY)[0]
        for m in re.finditer(r"(?<![\d-])\d{16}(?!\d)|(?<![\d-])\d{4}(?: \d{4}){3}(?![\d])", r.text or ""):
            if luhn_ok(only_digits(m.group())):
                seen["card"] += 1
                assert m.group() not in new
        for m in re.finditer(r"(?<![\w.+-])[\w.+-]{2,}@[\w-]+\.[a-z]{2,}", r.text or ""):
            if any(c.isascii() and c.isalnum() for c in m.group().split("@")[0]):
                seen["email"] += 1
                assert m.group() not in new
        for m in re.finditer(r"(?<![\d.])\d{1,3}(?:\.\d{1,3}){3}(?!\d|\.\d)", r.text or ""):
            parts = m.group().split(".")
            if all(int(x) < 256 and str(int(x)) == x for x in parts):
                seen["ip"] += 1
                assert m.group() not in new
    assert all(seen.values()), seen


def test_query(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    key = session_key(spark)
    rows = op3_pii(spark, SF0001).collect()
    assert len(rows) == len(docs) and sum(r.n_email + r.n_card + r.n_phone + r.n_ip for r in rows) > 0
    for r in rows:
        assert len(finds(docs[r.doc_id], key)) == sum(r[f"n_{k}"] for k in KINDS)
        assert pseudonymise(r.text, key, True)[0] == docs[r.doc_id]
