"""BPE encoding with content-defined chunk reuse, and decoding.

A rolling hash over the last ``WINDOW`` code points decides where a text is cut,
so equal passages are cut alike in every document.

* Chunk hashes are counted over all documents; the ``shared_chunks`` chunks that
  save most (copies times length) are encoded once, in Spark, and sent to all
  tasks.  Their number bounds memory only: every other chunk is encoded by the
  task that meets it (once, while it stays in the task's memo), to the same ids.
* Chunks join in the middle of words.  The splitting pattern of byte-level BPE
  never joins a space to a non-space before it, so the position between a
  non-space and a space is a boundary whatever stands around it (a *sure*
  boundary), and text between two of them has the same ids alone as in its
  document.  A chunk's reusable *core* lies between its first and last sure
  boundary; a join is repaired by re-encoding from the last sure boundary that
  is written to the first one of the next chunk, where both encodings agree.  A
  chunk without one is taken into the repair whole, which then goes on to the
  next chunk, until they agree or the text ends.
* Special tokens are cut out first and become their own ids.

Decoding maps ids to bytes and these to UTF-8; it is the exact inverse.

No shuffle carries texts or ids: each document is encoded where it is read, and
memory is bounded by a block of texts, the shared chunks and the memo.  The
vocabulary file's path is a parameter and must exist on every machine.

Edge cases: null and empty texts have no ids; a text without a cut or without a
space is encoded whole; repeated rows are encoded row by row; an empty table
gives an empty result; other columns are never read.
"""
from __future__ import annotations

import base64
import functools
import hashlib
import re
from array import array
from dataclasses import dataclass

import numpy as np
import pandas as pd
import public_tokenizers
import tiktoken
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stride.llm.common import (_BASE, _INV, _ODD, _power, codes_of, map_texts, mix64, read_table,
                               run_hashes, stored, text_blocks)

WINDOW = 16


@dataclass(frozen=True)
class BpeParams:
    ranks: str = public_tokenizers.path("byte_bpe_50k.tiktoken")
    pattern: str = public_tokenizers.PATTERN
    special: tuple = (("<|endoftext|>", 50256),)
    mean_chunk: int = 1024       # code points between cuts, on average (a power of two)
    least_chunk: int = 64
    longest_chunk: int = 8192    # a longer stretch is cut where its window hash is largest
    shared_chunks: int = 8192    # encoded once for all tasks
    memo_chunks: int = 4096      # kept by a task


def sure_boundaries(part: str) -> tuple[int, int] | None:
    """First and last position with a non-space before and a space after it; None if there are not two."""
    first = part.find(" ", 1)
    while first > 0 and part[first - 1].isspace():
        first = part.find(" ", first + 1)
    last = part.rfind(" ", 1)
    while last > first and part[last - 1].isspace():
        last = part.rfind(" ", 1, last)
    return (first, last) if 0 < first < last else None


class Codec:
    """Encoder and decoder over one vocabulary."""

    def __init__(self, p: BpeParams):
        with open(p.ranks, "rb") as f:
            ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
        self.p, self.special = p, dict(p.special)
        self.bpe = tiktoken.Encoding("chunks", pat_str=p.pattern, mergeable_ranks=ranks, special_tokens=self.special)
        self.marks = re.compile("|".join(map(re.escape, self.special))) if self.special else None
        self.encode = self.bpe.encode_ordinary
        self.memo: dict[int, tuple] = {}

    def core(self, key: int, part: str, shared: dict) -> tuple | None:
        """(chunk, core begin, core end, core ids) of a chunk, None without two sure boundaries."""
        for known in (shared, self.memo):
            hit = known.get(key)
            if hit is not None and hit[0] == part:
                return hit
        at = sure_boundaries(part)
        if at is None:
            return None
        hit = (part, *at, self.encode(part[at[0]:at[1]]))
        if len(self.memo) >= self.p.memo_chunks:
            self.memo.clear()
        self.memo[key] = hit
        return hit

    def encode_chunks(self, text: str, bounds: list[int], keys: list[int], shared: dict) -> list[int]:
        """Ids of a text without special tokens from its chunks, joins repaired."""
        out: list[int] = []
        written = 0
        for a, b, key in zip(bounds, bounds[1:], keys):
            hit = self.core(key, text[a:b], shared)
            if hit is not None:
                if written < a + hit[1]:
                    out += self.encode(text[written:a + hit[1]])
                out += hit[3]
                written = a + hit[2]
        if written < len(text):
            out += self.encode(text[written:])
        return out

    def decode(self, ids: list[int]) -> str:
        return self.bpe.decode_bytes(ids).decode("utf-8", errors="replace")

    def segments(self, text: str):
        """(begin, end, special id or None), in order."""
        at = 0
        for m in self.marks.finditer(text) if self.marks else ():
            if m.start() > at:
                yield at, m.start(), None
            yield m.start(), m.end(), self.special[m.group()]
            at = m.end()
        if at < len(text):
            yield at, len(text), None


@functools.lru_cache(maxsize=4)
def codec(p: BpeParams) -> Codec:
    return Codec(p)


def block_chunks(texts: list[str], p: BpeParams):
    """For each text of a block its segments as (begin, end, special id, bounds, chunk hashes)."""
    codes, starts = codes_of(texts)
    n = len(codes)
    cuts, mixed = np.zeros(0, np.int64), np.zeros(0, np.uint64)
    if n > WINDOW:
        total = np.zeros(n + 1, np.uint64)
        np.cumsum(mix64(codes.astype(np.uint64) * _ODD + _ODD) * _power(_BASE, n), out=total[1:])
        roll = (total[WINDOW:] - total[:-WINDOW]) * _power(_INV, n)[:n - WINDOW + 1]
        mixed = mix64(roll)
        cuts = np.flatnonzero(mixed & np.uint64(p.mean_chunk - 1) == 0) + WINDOW
    marks = codec(p)
    plans, begin, end = [], [], []
    for text, s in zip(texts, starts.tolist()):
        lo, hi = np.searchsorted(cuts, [s + p.least_chunk, s + len(text)])
        own = (cuts[lo:hi] - s).tolist()  # positions in the text
        plan = []
        for a, b, special in marks.segments(text):
            bounds = [a]
            if special is None:
                for c in [*own, b]:
                    if c == b or bounds[-1] + p.least_chunk <= c <= b - p.least_chunk:
                        while c - bounds[-1] > p.longest_chunk:  # no cut for long: repetitive text
                            first = s + bounds[-1] + p.longest_chunk // 2 - WINDOW
                            last = min(first + p.longest_chunk // 2, s + c - p.least_chunk - WINDOW)
                            bounds.append(first + int(mixed[first:last].argmax()) + WINDOW - s)
                        bounds.append(c)
                begin += [s + x for x in bounds[:-1]]
                end += [s + x for x in bounds[1:]]
            plan.append((a, b, special, bounds))
        plans.append(plan)
    keys = run_hashes(codes, np.array(begin, np.int64), np.array(end, np.int64)).view(np.int64).tolist()
    at = 0
    for plan in plans:
        out = []
        for a, b, special, bounds in plan:
            k = 0 if special is not None else len(bounds) - 1
            out.append((a, b, special, [x - a for x in bounds], keys[at:at + k]))
            at += k
        yield out


def encode_block(texts: list[str], p: BpeParams, shared: dict) -> list[list[int]]:
    c, out = codec(p), []
    for text, plan in zip(texts, block_chunks(texts, p)):
        ids: list[int] = []
        for a, b, special, bounds, keys in plan:
            if special is not None:
                ids.append(special)
            else:
                ids += c.encode_chunks(text[a:b], bounds, keys, shared)
        out.append(ids)
    return out


def shared_cores(docs: DataFrame, p: BpeParams) -> dict[int, tuple]:
    """The chunks that save most, each encoded once: hash -> (chunk, core begin, core end, ids)."""

    def count(batches):
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            for block in text_blocks(texts):
                found = [(k, y - x) for plan in block_chunks(texts[block], p) for *_, bounds, keys in plan
                         for k, x, y in zip(keys, bounds, bounds[1:])]
                if found:
                    yield pd.DataFrame(found, columns=["key", "chars"])

    texts = docs.select("text")
    chosen = (texts.mapInPandas(count, "key long, chars long").groupBy("key")
              .agg(F.count("*").alias("copies"), F.max("chars").alias("chars")).where("copies > 1")
              .orderBy(F.desc(F.expr("(copies - 1) * chars")), "key").limit(p.shared_chunks).select("key"))
    wanted = docs.sparkSession.sparkContext.broadcast({r.key for r in chosen.collect()})  # at most shared_chunks

    def pick(batches):
        seen: set[int] = set()
        for pdf in batches:
            texts = [t or "" for t in pdf["text"]]
            for block in text_blocks(texts):
                rows = []
                for text, plan in zip(texts[block], block_chunks(texts[block], p)):
                    for a, _, _, bounds, keys in plan:
                        for k, x, y in zip(keys, bounds, bounds[1:]):
                            if k in wanted.value and k not in seen:
                                seen.add(k)
                                rows.append((k, text[a + x:a + y]))
                if rows:
                    yield pd.DataFrame(rows, columns=["key", "chunk"])

    def encode(batches):
        c = codec(p)
        for pdf in batches:
            rows = []
            for key, chunk in zip(pdf["key"], pdf["chunk"]):
                at = sure_boundaries(chunk)
                if at is not None:
                    rows.append((key, chunk, *at, np.array(c.encode(chunk[at[0]:at[1]]), np.int32)))
            yield pd.DataFrame(rows, columns=["key", "chunk", "begin", "end", "ids"])

    one = texts.mapInPandas(pick, "key long, chunk string").groupBy("key").agg(F.min("chunk").alias("chunk"))
    done = stored(one.mapInPandas(encode, "key long, chunk string, begin int, end int, ids array<int>"), "bpe-shared")
    return {r.key: (r.chunk, r.begin, r.end, list(r.ids)) for r in done.toLocalIterator()}  # at most shared_chunks


def encode_documents(docs: DataFrame, p: BpeParams = BpeParams(), digest: bool = False) -> DataFrame:
    """doc_id, n_tokens and the ids (array) and decoded text of each document, or with ``digest`` their SHA-256."""
    shared = docs.sparkSession.sparkContext.broadcast(shared_cores(docs, p))
    sha = lambda b: hashlib.sha256(b).hexdigest()

    def run(texts):
        c, ids = codec(p), encode_block(texts, p, shared.value)
        out = {"n_tokens": [len(x) for x in ids]}
        if digest:
            out["ids_sha256"] = [sha(np.frombuffer(array("I", x), np.uint32).astype("<u4").tobytes()) for x in ids]
            out["decoded_sha256"] = [sha(c.decode(x).encode()) for x in ids]
        else:
            out["ids"] = [np.array(x, np.int32) for x in ids]
            out["decoded"] = [c.decode(x) for x in ids]
        return out

    tail = "ids_sha256 string, decoded_sha256 string" if digest else "ids array<int>, decoded string"
    return map_texts(docs, ["doc_id"], f"n_tokens long, {tail}", run)


def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return encode_documents(read_table(spark, sf_dir, "documents"), digest=True)


def bpe_stage(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token counts and digests of ids and decoded text of the documents that are left."""
    return encode_documents(docs, digest=True)
