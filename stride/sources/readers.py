"""File scans with header contracts and provenance (SRC-1..5)."""
from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import schemas as S


class HeaderContractError(ValueError):
    """Input file columns do not match the declared contract."""


def typed(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Text columns cast to the contract's types; a value that does not parse raises,
    whatever the session's ANSI setting (a permissive reader would make it NULL)."""
    cols = []
    for f in schema.fields:
        c = F.col(f"`{f.name}`")
        value = c.try_cast(f.dataType)
        bad = F.raise_error(F.concat(F.lit(f"invalid {f.dataType.simpleString()} in column {f.name}: "), c))
        cols.append((c if f.dataType == T.StringType() else F.when(c.isNotNull() & value.isNull(), bad).otherwise(value))
                    .alias(f.name))
    return df.select(*cols)


def _reader(spark: SparkSession, fmt: str, schema: T.StructType | None = None,
            options: Mapping[str, str] | None = None):
    r = spark.read.format(fmt).options(**(options or {}))
    if fmt == "csv":
        r = r.option("header", True).option("enforceSchema", False).option("mode", "FAILFAST")
    if schema is not None:
        r = r.schema(schema)
    return r


def file_header(spark: SparkSession, path: str, fmt: str) -> list[str]:
    """Column names as stored in the file (CSV: first line; Parquet: footer)."""
    r = spark.read.format(fmt)
    if fmt == "csv":
        r = r.option("header", True).option("inferSchema", False)
    return r.load(path).columns


def check_ordered_header(columns: Iterable[str], expected: Iterable[str]) -> None:
    """SRC-1: exact ordered header list; any difference raises."""
    columns, expected = list(columns), list(expected)
    if columns != expected:
        raise HeaderContractError(f"unexpected columns {columns}, expected {expected}")


def check_header_set(columns: Iterable[str], expected: Iterable[str]) -> None:
    """SRC-2: header set, order free."""
    columns, expected = list(columns), list(expected)
    if set(columns) != set(expected) or len(columns) != len(expected):
        raise HeaderContractError(f"unexpected columns {sorted(columns)}, expected {sorted(expected)}")


def with_provenance(df: DataFrame, column_map: Mapping[str, str],
                    source_file: str | None = None,
                    loaded_at: dt.datetime | None = None) -> DataFrame:
    """SRC-3: rename by map, add ``source_file`` (base name) and ``loaded_at``.

    ``source_file`` defaults to the scanned file's base name from the hidden
    ``_metadata`` column, so it must be applied to a file scan.
    """
    out = df.withColumnsRenamed(dict(column_map))
    src = F.lit(source_file) if source_file is not None else \
        F.col("source_file" if "source_file" in df.columns else "_metadata.file_name")
    ts = F.lit(loaded_at).cast("timestamp_ntz") if loaded_at is not None \
        else F.current_timestamp().cast("timestamp_ntz")
    return out.withColumns({"source_file": src, "loaded_at": ts})


def scan_with_contract(spark: SparkSession, path: str, column_map: Mapping[str, str],
                       ordered: bool, fmt: str = "parquet",
                       schema: T.StructType | None = None,
                       loaded_at: dt.datetime | None = None,
                       options: Mapping[str, str] | None = None) -> DataFrame:
    """Scan a file whose header must match ``column_map``'s keys, then rename."""
    header = file_header(spark, path, fmt)
    (check_ordered_header if ordered else check_header_set)(header, column_map.keys())
    return with_provenance(_scan(spark, path, fmt, header, schema, options), column_map, loaded_at=loaded_at)


def _scan(spark: SparkSession, path: str, fmt: str, header: list[str], schema: T.StructType | None,
          options: Mapping[str, str] | None) -> DataFrame:
    """The file's columns in its own order; text files are read as text and cast by name."""
    if schema is None:
        df = _reader(spark, fmt, None, options).load(path)
        return df.select("*", F.col("_metadata.file_name").alias("source_file"))
    text = T.StructType([T.StructField(h, T.StringType()) for h in header])
    df = _reader(spark, fmt, text, options).load(path)
    df = df.select("*", F.col("_metadata.file_name").alias("source_file"))
    by_name = {f.name: f for f in schema.fields}
    return typed(df, T.StructType([*[by_name[h] for h in header], T.StructField("source_file", T.StringType())]))


def scan_hr_file(spark: SparkSession, path: str, fmt: str = "csv",
                 loaded_at: dt.datetime | None = None,
                 options: Mapping[str, str] | None = None) -> DataFrame:
    """HR file: 11 columns, order checked."""
    schema = S.HR_FILE_SCHEMA if fmt == "csv" else None
    return scan_with_contract(spark, path, S.HR_COLUMN_MAP, True, fmt, schema, loaded_at, options)


def scan_sport_file(spark: SparkSession, path: str, fmt: str = "csv",
                    loaded_at: dt.datetime | None = None,
                    options: Mapping[str, str] | None = None) -> DataFrame:
    """Sport file: two columns, order free."""
    header = file_header(spark, path, fmt)
    check_header_set(header, S.SPORT_COLUMN_MAP.keys())
    schema = S.SPORT_FILE_SCHEMA if fmt == "csv" else None
    return with_provenance(_scan(spark, path, fmt, header, schema, options), S.SPORT_COLUMN_MAP, loaded_at=loaded_at)


def scan_payload_documents(spark: SparkSession, path: str, array_field: str | None = None) -> DataFrame:
    """SRC-5 for files: one JSON document per line, or a multi-line document
    whose ``array_field`` holds the records (exploded into rows)."""
    if array_field is None:
        return spark.read.schema(S.ACTIVITY_PAYLOAD_SCHEMA).option("mode", "FAILFAST").json(path)
    wrapper = T.StructType([T.StructField(array_field, T.ArrayType(S.ACTIVITY_PAYLOAD_SCHEMA))])
    doc = spark.read.option("multiLine", True).option("mode", "FAILFAST").schema(wrapper).json(path)
    return doc.select(F.explode(F.col(array_field)).alias("r")).select("r.*")
