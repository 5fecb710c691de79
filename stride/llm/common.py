"""Helpers shared by the training-data operators: input reading, tables in the
shared work folder, and vectorised word hashing used inside Arrow-batched tasks."""
from __future__ import annotations

import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import StructType

from stride.session import work_path

BLOCK_CHARS = 1 << 20  # code points handled at once inside a task (a longer text is handled alone)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, name: str, compression: str = "lz4") -> DataFrame:
    """Write ``df`` under the shared work folder and read it back: the lineage
    ends there, so a lost executor costs no more than the stage that reads it."""
    spark = df.sparkSession
    path = work_path(spark, "llm", f"{name}-{uuid.uuid4().hex}")
    df.write.option("compression", compression).parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def text_blocks(texts: list, max_chars: int = BLOCK_CHARS) -> Iterator[slice]:
    """Slices of ``texts`` of at most ``max_chars`` code points (or one text)."""
    start, total = 0, 0
    for i, t in enumerate(texts):
        n = len(t) if t else 0
        if i > start and total + n > max_chars:
            yield slice(start, i)
            start, total = i, 0
        total += n
    if start < len(texts):
        yield slice(start, len(texts))


def map_texts(docs: DataFrame, keep: list[str], added: str, fn, text: str = "text", max_chars: int = BLOCK_CHARS) -> DataFrame:
    """Columns ``keep`` as they are, and the columns ``added`` (DDL) that
    ``fn(texts) -> {column: values}`` makes from a block of whole texts (null: empty)."""
    schema = StructType(docs.select(*keep).schema.fields + StructType.fromDDL(added).fields)
    arrow = to_arrow_schema(schema)
    names = arrow.names[len(keep):]

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(len(keep)).to_pylist()]
            parts = [fn(texts[block]) for block in text_blocks(texts, max_chars)] or [fn([])]
            new = [pa.concat_arrays([pa.array(part[n], type=arrow.field(n).type) for part in parts]) for n in names]
            yield pa.RecordBatch.from_arrays([*batch.columns[:len(keep)], *new], schema=arrow)

    return docs.select(*keep, F.col(text).alias("__text")).mapInArrow(run, schema)


def expand_texts(docs: DataFrame, key: str, made: str, fn, text: str = "text") -> DataFrame:
    """``fn(texts) -> (text numbers, {column: values})``: any number of rows for
    each text, with the text's ``key`` in front of the columns ``made`` (DDL)."""
    schema = StructType(docs.select(key).schema.fields + StructType.fromDDL(made).fields)
    arrow = to_arrow_schema(schema)

    def run(batches):
        for batch in batches:
            texts = [t or "" for t in batch.column(1).to_pylist()]
            for block in text_blocks(texts):
                number, columns = fn(texts[block])
                if len(number):
                    keys = batch.column(0).take(pa.array(np.asarray(number) + block.start, pa.int64()))
                    yield pa.RecordBatch.from_arrays(
                        [keys, *(pa.array(columns[n], type=arrow.field(n).type) for n in arrow.names[1:])], schema=arrow)

    return docs.select(key, F.col(text).alias("__text")).mapInArrow(run, schema)


# --------------------------------------------------------------------------
# Vectorised words: code points -> word boundaries -> 64-bit word hashes
# --------------------------------------------------------------------------
_ODD = np.uint64(0x9E3779B97F4A7C15)
_BASE = 0x2545F4914F6CDD1D  # odd, so that it has an inverse modulo 2**64
_INV = pow(_BASE, -1, 1 << 64)
_powers: dict[int, np.ndarray] = {}


def _power(base: int, n: int) -> np.ndarray:
    have = _powers.get(base)
    if have is None or len(have) < n:
        size = 1 << max(16, (n - 1).bit_length())
        step = np.full(size, base, dtype=np.uint64)
        step[0] = 1
        have = _powers[base] = np.cumprod(step, dtype=np.uint64)
    return have[:n]


def mix64(x: np.ndarray) -> np.ndarray:
    """splitmix64 finaliser (wrapping arithmetic)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def codes_of(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Code points of the texts joined by line feeds, and each text's start."""
    joined = "\n".join(texts)
    codes = np.frombuffer(joined.encode("utf-32-le", "surrogatepass"), dtype=np.uint32)
    lengths = np.fromiter((len(t) + 1 for t in texts), dtype=np.int64, count=len(texts))
    starts = np.zeros(len(texts), dtype=np.int64)
    np.cumsum(lengths[:-1], out=starts[1:])
    return codes, starts


def lower_ascii(codes: np.ndarray) -> np.ndarray:
    return np.where((codes >= 65) & (codes <= 90), codes + np.uint32(32), codes)


def is_space(codes: np.ndarray) -> np.ndarray:
    """The white space of the shingle contract: space, tab to carriage return."""
    return (codes == 32) | ((codes >= 9) & (codes <= 13))


def _table(test) -> np.ndarray:
    return np.fromiter((test(chr(c)) for c in range(1 << 16)), dtype=bool, count=1 << 16)


_alnum: list[np.ndarray] = []


def is_alnum(codes: np.ndarray) -> np.ndarray:
    """Letters and digits (all code points beyond the basic plane count)."""
    if not _alnum:
        _alnum.append(_table(str.isalnum))
    return (codes >= (1 << 16)) | _alnum[0][np.minimum(codes, 0xFFFF)]


def runs(mask: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the runs of true values."""
    edge = np.diff(mask.astype(np.int8), prepend=0, append=0)
    return np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)


def run_hashes(codes: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each run of code points (equal runs, equal hashes)."""
    if not len(begin):
        return np.zeros(0, dtype=np.uint64)
    n = len(codes)
    total = np.zeros(n + 1, dtype=np.uint64)
    np.cumsum(mix64(codes.astype(np.uint64) * _ODD + _ODD) * _power(_BASE, n), out=total[1:])
    raw = (total[end] - total[begin]) * _power(_INV, n)[begin]
    return mix64(raw + (end - begin).astype(np.uint64) * _ODD)


def words_of(texts: list[str], space: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Hash and text number of each word of a block.  ``space``: words are runs
    of non-space characters, A-Z lower-cased; otherwise runs of letters and
    digits of the lower-cased text."""
    if space:
        codes, starts = codes_of(texts)
        codes = lower_ascii(codes)
        begin, end = runs(~is_space(codes))
    else:
        codes, starts = codes_of([t.lower() for t in texts])
        begin, end = runs(is_alnum(codes))
    return run_hashes(codes, begin, end), np.searchsorted(starts, begin, side="right") - 1
