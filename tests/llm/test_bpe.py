import hashlib
import random

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

from tests.conftest import SF0001
from stride.llm.bpe import BpeParams, block_chunks, codec, encode_block, encode_documents, op7_bpe, sure_boundaries

LIBRARY = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
BITS = ["a", "b", "  ", "\n", " ", "é", " ", "　", "\x1c", "\x85", "'s", "'", "1", "23", ".", "😀", "<|endoftext|>",
        "<|endof", "word ", " \n ", "\t", "the ", "ñ", "中", "​", " "]


def texts():
    rnd = random.Random(3)
    made = ["".join(rnd.choice(BITS) for _ in range(rnd.randint(0, 400))) for _ in range(600)]
    passage = " ".join(f"w{rnd.randrange(500)}" for _ in range(2000))
    return made + [passage, "x" + passage, passage[7:] + passage, "", " ", " " * 700, "a" * 4000, "a b", "<|endoftext|>"]


def test_ids_equal_the_library():
    rows = texts()
    want = [e.ids for e in LIBRARY.encode_batch(rows, add_special_tokens=False)]
    for p in (BpeParams(), BpeParams(mean_chunk=16, least_chunk=4), BpeParams(mean_chunk=64, least_chunk=1, memo_chunks=3)):
        assert encode_block(rows, p, {}) == want
        assert [codec(p).decode(x) for x in want] == [LIBRARY.decode(x, skip_special_tokens=False) for x in want] == rows


def test_chunks_have_a_longest_length():
    for text in ("ab " * 400_000, "a" * 50_000, "x y " * 3000 + "<|endoftext|>" + "ab " * 30_000):
        p = BpeParams()
        (plan,) = block_chunks([text], p)
        sizes = [y - x for *_, bounds, _ in plan for x, y in zip(bounds, bounds[1:])]
        assert max(sizes) <= p.longest_chunk and sum(sizes) + text.count("<|endoftext|>") * 13 == len(text)
    text = "ab cd " * 5000
    assert encode_block([text], BpeParams(longest_chunk=512), {}) == [LIBRARY.encode(text, add_special_tokens=False).ids]


def test_sure_boundaries():
    assert sure_boundaries("ab cd  ef gh") == (2, 9)
    assert sure_boundaries("ab") is None and sure_boundaries(" a") is None and sure_boundaries("a b") is None


def test_rows(spark, docs):
    rows = [(i, t) for i, t in enumerate(texts()[-40:])] + [(None, None), (3, "x y"), (3, "x y")]
    out = encode_documents(docs(rows), BpeParams(mean_chunk=32, least_chunk=8)).collect()
    got = sorted((str(r.doc_id), tuple(r.ids), r.decoded, r.n_tokens) for r in out)
    want = [(str(i), tuple(LIBRARY.encode(t or "", add_special_tokens=False).ids), t or "") for i, t in rows]
    assert got == sorted((*w, len(w[1])) for w in want)
    assert encode_documents(docs([])).collect() == []


def test_query(spark):
    rows = {r.doc_id: r.text for r in spark.read.parquet(f"{SF0001}/documents.parquet").collect()}
    out = op7_bpe(spark, SF0001).collect()
    assert len(out) == len(rows)
    for r in out:
        ids = LIBRARY.encode(rows[r.doc_id] or "", add_special_tokens=False).ids
        assert r.n_tokens == len(ids)
        assert r.ids_sha256 == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        assert r.decoded_sha256 == hashlib.sha256(LIBRARY.decode(ids, skip_special_tokens=False).encode()).hexdigest()
