"""Language identification with spans: script ranges, word scores, Viterbi.

Learning counts hashed character n-grams (1 to 3, with word ends) per language
over all documents that may be learned from: each task adds its texts up in one
table per language, the tables are summed in Spark, and the result (languages x
``2**BITS`` numbers, whatever the corpus) goes to every task.  How often each
script occurs per language is learned in the same pass.

Prediction: a word (a run of letters) has, for each language, the sum of its
n-grams' log probabilities.  The script of a word narrows the candidates to the
languages that were seen in that script.  Viterbi over the words of a document,
with a fixed penalty for switching, labels spans of mixed-language text.  All
documents of a block run in lockstep: texts are cut into pieces of ``PIECE``
words, each piece is solved for every language before it, and the pieces are
chained, so long texts need no long loops and the result is the exact path.

A document's label is the language of most letters (ties: alphabetical order),
its score that language's share of the letters.

Edge cases: null texts and texts without a letter are ``und`` with score 0; a
null lang is not learned from; with nothing to learn from every text is ``und``;
repeated rows are labelled row by row; an empty table gives an empty result;
other columns are never read.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stride.llm.common import (codes_of, map_texts, mix64, read_table, runs, text_blocks)

BITS = 16
PIECE = 128
#: First code points of the ranges that scripts use (a range ends where the next begins).
SCRIPTS = [(0x0000, "latin"), (0x0370, "greek"), (0x0400, "cyrillic"), (0x0530, "armenian"), (0x0590, "hebrew"),
           (0x0600, "arabic"), (0x0900, "devanagari"), (0x0980, "indic"), (0x0E00, "thai"), (0x0E80, "other"),
           (0x10A0, "georgian"), (0x1100, "hangul"), (0x1200, "other"), (0x1E00, "latin"), (0x1F00, "greek"),
           (0x2000, "other"), (0x3040, "kana"), (0x3130, "hangul"), (0x3190, "han"), (0xA000, "other"),
           (0xAC00, "hangul"), (0xD7B0, "other"), (0xF900, "han"), (0xFB00, "other")]
SCRIPT_NAMES = sorted({name for _, name in SCRIPTS})
_FIRST = np.array([a for a, _ in SCRIPTS])
_SCRIPT = np.array([SCRIPT_NAMES.index(name) for _, name in SCRIPTS])
_alpha: list[np.ndarray] = []


@dataclass(frozen=True)
class LanguageParams:
    switch: float = 12.0        # cost of changing the language between two words
    smooth: float = 0.5         # added to each n-gram count
    script_share: float = 0.002  # least share of a language's letters for a script to be its own


def letters(codes: np.ndarray) -> np.ndarray:
    """Which code points are letters (of any plane)."""
    if not _alpha:
        _alpha.append(np.fromiter((chr(c).isalpha() for c in range(0x110000)), dtype=bool, count=0x110000))
    return _alpha[0][codes]


def lower(text: str) -> str:
    """The text in lower case, code point by code point where it would grow, so that places stay."""
    low = text.lower()
    return low if len(low) == len(text) else "".join(c.lower() if len(c.lower()) == 1 else c for c in text)


def grams(texts: list[str]):
    """Words of a block: (text number, begin, end) and, for each of its n-grams, the word number and bucket; scripts."""
    codes, starts = codes_of([lower(t) for t in texts])
    begin, end = runs(letters(codes))
    size = end - begin
    text = np.searchsorted(starts, begin, side="right") - 1
    # the letters of all words, each word between two marks
    width = size + 2
    first = np.cumsum(width) - width
    total = int(width.sum())
    word = np.repeat(np.arange(len(size)), width)
    inner = np.arange(total) - first[word]
    c = np.zeros(total, np.uint64)
    inside = (inner > 0) & (inner <= size[word])
    c[inside] = codes[(begin[word] + inner - 1)[inside]]
    script = np.zeros(len(size), np.int64)
    if len(size):
        script = _SCRIPT[np.searchsorted(_FIRST, codes[begin], side="right") - 1]
    shift = np.uint64(64 - BITS)
    buckets = [(mix64(c + np.uint64(1 << 40)) >> shift)[inside]]
    owners = [word[inside]]
    for n in (2, 3):
        if total >= n:
            acc = np.full(total - n + 1, n << 40, np.uint64)
            for j in range(n):
                acc = acc * np.uint64(0x110001) + c[j:total - n + 1 + j]
            same = word[:total - n + 1] == word[n - 1:]
            buckets.append((mix64(acc) >> shift)[same])
            owners.append(word[:total - n + 1][same])
    return text, begin - starts[text] if len(size) else begin, size, script, np.concatenate(owners), np.concatenate(buckets).astype(np.int64)


@dataclass(frozen=True)
class LanguageModel:
    names: list[str]
    score: np.ndarray    # bucket x language: log probability less the bucket's mean
    allowed: np.ndarray  # script x language


def learn(docs: DataFrame, where=None, p: LanguageParams = LanguageParams()) -> LanguageModel:
    """Counts over all rows with a lang that satisfy ``where``."""
    rows = docs.where("lang is not null and text is not null")
    rows = (rows.where(where) if where is not None else rows).select("lang", "text")
    schema = pa.schema([("lang", pa.string()), ("script", pa.bool_()), ("slot", pa.int32()), ("n", pa.int64())])

    def count(batches):
        tables: dict[str, tuple[np.ndarray, np.ndarray]] = {}
        for batch in batches:
            lang = np.array(batch.column(0).to_pylist(), dtype=object)
            texts = batch.column(1).to_pylist()
            for block in text_blocks(texts):
                text, _, size, script, owner, bucket = grams(texts[block])
                own = lang[block]
                for name in set(own):
                    g, s = tables.setdefault(name, (np.zeros(1 << BITS, np.int64), np.zeros(len(SCRIPT_NAMES), np.int64)))
                    mine = (own == name)[text] if len(text) else np.zeros(0, bool)
                    g += np.bincount(bucket[mine[owner]], minlength=1 << BITS)
                    s += np.bincount(script[mine], weights=size[mine], minlength=len(SCRIPT_NAMES)).astype(np.int64)
        for name, pair in tables.items():
            for is_script, t in zip((False, True), pair):
                at = np.flatnonzero(t)
                yield pa.RecordBatch.from_arrays([pa.array([name] * len(at), pa.string()), pa.array([is_script] * len(at)),
                                                  pa.array(at, pa.int32()), pa.array(t[at])], schema=schema)

    summed = (rows.mapInArrow(count, "lang string, script boolean, slot int, n long")
              .groupBy("lang", "script", "slot").agg(F.sum("n").alias("n")).toArrow())  # languages x (2**BITS + scripts)
    langs = np.array(summed.column("lang").to_pylist(), dtype=object)
    names = sorted(set(langs))
    counts = np.zeros((1 << BITS, len(names)))
    scripts = np.zeros((len(SCRIPT_NAMES), len(names)))
    if names:
        no = np.searchsorted(np.array(names, dtype=object), langs)
        is_script = summed.column("script").to_numpy(zero_copy_only=False).astype(bool)
        slot, n = summed.column("slot").to_numpy(), summed.column("n").to_numpy()
        counts[slot[~is_script], no[~is_script]] = n[~is_script]
        scripts[slot[is_script], no[is_script]] = n[is_script]
    score = np.log((counts + p.smooth) / (counts.sum(axis=0) + p.smooth * (1 << BITS)) if names else counts + 1)
    if names:
        score -= score.mean(axis=1, keepdims=True)
    allowed = scripts >= np.maximum(p.script_share * scripts.sum(axis=0), 1)
    allowed[~allowed.any(axis=1)] = True  # a script never seen excludes nobody
    return LanguageModel(names, score, allowed)


def viterbi(score: np.ndarray, doc: np.ndarray, switch: float) -> np.ndarray:
    """The best language of each word; ``doc`` (rising) tells which words belong together."""
    n, k = score.shape
    out = np.zeros(n, np.int64)
    if not n:
        return out
    count = np.bincount(doc)
    start = np.cumsum(count) - count
    place = np.arange(n) - start[doc]
    head = np.flatnonzero(place % PIECE == 0)
    length = np.append(head[1:], n) - head
    order = np.argsort(-length, kind="stable")   # long pieces first: those still running are a prefix
    head, length, doc_of = head[order], length[order], doc[head][order]
    pieces = len(head)
    best = np.where(np.eye(k, dtype=bool), 0.0, -np.inf)[None].repeat(pieces, axis=0)  # piece, language before, language
    back = np.zeros((pieces, PIECE, k, k), np.int16)
    live = np.searchsorted(-length, -np.arange(PIECE), side="left")
    for t in range(int(length[0])):
        m = live[t]
        top = best[:m].argmax(axis=2)
        hop = np.take_along_axis(best[:m], top[:, :, None], axis=2) - switch
        move = hop > best[:m]
        back[:m, t] = np.where(move, top[:, :, None], np.arange(k))
        best[:m] = np.where(move, hop, best[:m]) + score[head[:m] + t][:, None, :]
    # chain the pieces of each document in order
    turn = place[head] // PIECE
    at_turn = np.lexsort((doc_of, turn))
    bounds = np.searchsorted(turn[at_turn], np.arange(turn.max() + 2))
    value = np.zeros((len(count), k))
    came = np.zeros((pieces, k), np.int64)
    for a, b in zip(bounds, bounds[1:]):
        i = at_turn[a:b]
        reach = value[doc_of[i]][:, :, None] + best[i]
        came[i] = reach.argmax(axis=1)
        value[doc_of[i]] = reach.max(axis=1)
    last = value.argmax(axis=1)
    before, after = np.zeros(pieces, np.int64), np.zeros(pieces, np.int64)
    for a, b in reversed(list(zip(bounds, bounds[1:]))):
        i = at_turn[a:b]
        after[i] = last[doc_of[i]]
        before[i] = came[i, after[i]]
        last[doc_of[i]] = before[i]
    state = after.copy()
    for t in range(int(length[0]) - 1, -1, -1):
        m = live[t]
        out[head[:m] + t] = state[:m]
        state[:m] = back[np.arange(m), t, before[:m], state[:m]]
    return out


def label(texts: list[str], model: LanguageModel, p: LanguageParams) -> dict:
    """lang_pred, score and the spans (begin, end, lang) of each text."""
    n, k = len(texts), len(model.names)
    if not k:
        return {"lang_pred": ["und"] * n, "score": [0.0] * n, "spans": [[] for _ in texts]}
    text, begin, size, script, owner, bucket = grams(texts)
    words = len(text)
    score = np.stack([np.bincount(owner, weights=model.score[bucket, j], minlength=words) for j in range(k)], axis=1) \
        if words else np.zeros((0, k))
    score = np.where(model.allowed[script], score, -1e6) if words else score
    path = viterbi(score, text, p.switch)
    mass = np.bincount(text * k + path, weights=size, minlength=n * k).reshape(n, k)
    total = mass.sum(axis=1)
    best = mass.argmax(axis=1)
    turn = np.flatnonzero(np.append(True, (path[1:] != path[:-1]) | (text[1:] != text[:-1]))) if words else np.zeros(0, int)
    stop = np.append(turn[1:], words) - 1 if words else turn
    spans: list[list] = [[] for _ in texts]
    for a, b in zip(turn.tolist(), stop.tolist()):
        spans[text[a]].append({"begin": int(begin[a]), "end": int(begin[b] + size[b]), "lang": model.names[path[a]]})
    return {"lang_pred": [model.names[i] if t else "und" for i, t in zip(best, total)],
            "score": mass.max(axis=1) / np.maximum(total, 1), "spans": spans}


def identify(docs: DataFrame, model: LanguageModel, p: LanguageParams = LanguageParams()) -> DataFrame:
    """doc_id, lang_pred, score and spans (code points of the lower-cased text) of each document."""
    sent = docs.sparkSession.sparkContext.broadcast(model)
    made = "lang_pred string, score double, spans array<struct<begin:int,end:int,lang:string>>"
    return map_texts(docs, ["doc_id"], made, lambda texts: label(texts, sent.value, p))


def fold():
    """Remainder of crc32(doc_id as text) by 4: rows of fold 2 are held out."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4


def op10_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    model = learn(docs.select("doc_id", "lang", "text"), fold() != 2)
    return identify(docs.select("doc_id", "text"), model).select(
        "doc_id", F.coalesce(fold() == 2, F.lit(False)).alias("held_out"), "lang_pred", "score", F.size("spans").alias("n_spans"))
