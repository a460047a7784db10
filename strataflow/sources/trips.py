"""Trip sources: fixed-schema scan (S1), schema-reconciling load (S2-S4), union."""

from __future__ import annotations

import posixpath
import re
from collections.abc import Iterable, Sequence
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from .schema import TRIP_SCHEMA


def read_trips(spark: SparkSession, path: str | Sequence[str],
               schema: StructType = TRIP_SCHEMA, key_col: str | None = None) -> DataFrame:
    """Parquet scan with an explicit schema.

    Columns absent from a file read as null. A schema type that disagrees
    with a file's physical type (long over DOUBLE, double over INT64) fails
    at run time; use :func:`read_reconciled` for mixed inputs. ``key_col``
    adds :func:`file_row_key`.
    """
    paths = [path] if isinstance(path, str) else list(path)
    df = spark.read.schema(schema).parquet(*paths)
    return df.select("*", file_row_key(paths).alias(key_col)) if key_col else df


def conform_columns(df: DataFrame, schema: StructType = TRIP_SCHEMA) -> list[Column]:
    """Columns projecting ``df`` onto ``schema``: case-insensitive match,
    cast, typed nulls for missing columns (extra columns are dropped)."""
    by_lower = {c.lower(): c for c in df.columns}
    cols = []
    for f in schema.fields:
        src = by_lower.get(f.name.lower())
        if src is None:
            cols.append(F.lit(None).cast(f.dataType).alias(f.name))
        else:
            cols.append(F.col(f"`{src}`").cast(f.dataType).alias(f.name))
    return cols


def conform(df: DataFrame, schema: StructType = TRIP_SCHEMA) -> DataFrame:
    """Project ``df`` onto ``schema``."""
    return df.select(*conform_columns(df, schema))


def _root(paths: Sequence[str]) -> str:
    """The folder that all paths share, without scheme and host."""
    plain = [re.sub(r"^[A-Za-z][A-Za-z0-9+.-]*:(//[^/]*)?", "", p).rstrip("/") for p in paths]
    folders = [p.rsplit("/", 1)[0] if p.endswith(".parquet") else p for p in plain]
    return posixpath.commonpath(folders) if len({f.startswith("/") for f in folders}) == 1 else ""


def file_row_key(paths: Sequence[str]) -> Column:
    """Stable unique row key of a Parquet row: '<path below the read root>:<row index>'.

    Trip files carry no key; the file-source metadata gives one that is the
    same on every run and for any partitioning, unique by construction
    (unlike a hash of the row's values, which identical rows share), and
    cheap: no per-row hashing of all columns, and a small expression for the
    optimizer to push through unions and filters. The whole path below the
    folder that ``paths`` share is kept (``year=2023/month=01/part-0``), while
    moving the dataset to another place keeps the keys.
    """
    root = _root(paths)
    path = F.col("_metadata.file_path")
    where = F.substring_index(path, root + "/", -1) if root not in ("", "/") else path
    return F.concat_ws(":", where, F.col("_metadata.row_index").cast("string"))


def union_by_name(frames: Iterable[DataFrame]) -> DataFrame:
    """Union by column name, keeping duplicates."""
    frames = list(frames)
    if not frames:
        raise ValueError("union_by_name needs at least one frame")
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), frames)


def _agreeing(spark: SparkSession, files: list[str]) -> list[tuple[StructType, list[str]]]:
    """Files in groups whose footers can be merged into one schema.

    Spark reads the footers of a whole group in one distributed job; a group
    whose types conflict is halved, so jobs follow the number of conflicts,
    not of files."""
    try:
        return [(spark.read.option("mergeSchema", "true").parquet(*files).schema, files)]
    except Exception as e:  # noqa: BLE001  Spark's own error for schemas that do not merge
        if len(files) == 1 or "MERGE" not in str(e).upper():
            raise
    half = len(files) // 2
    return _agreeing(spark, files[:half]) + _agreeing(spark, files[half:])


def read_reconciled(spark: SparkSession, paths: Sequence[str],
                    schema: StructType = TRIP_SCHEMA, key_col: str | None = None) -> DataFrame:
    """Schema-reconciling load.

    Files are grouped by footer schemas that merge; each group is ONE scan of
    all its files (not one scan per file), conformed to ``schema`` with casts,
    and the groups are unioned by name. So twelve months that agree on their
    types are one scan, and months that disagree on INT64 vs DOUBLE are two.
    Filters and projections applied later still push into every scan.
    ``key_col`` adds a stable unique row key (:func:`file_row_key`).
    """
    files = sorted(spark.read.parquet(*paths).inputFiles())
    groups: dict[str, tuple[StructType, list[str]]] = {}
    for found, fs in _agreeing(spark, files):
        groups.setdefault(found.json(), (found, []))[1].extend(fs)
    frames = []
    for _, (found, fs) in sorted(groups.items()):
        raw = spark.read.schema(found).parquet(*fs)
        cols = conform_columns(raw, schema)
        if key_col:
            cols.append(file_row_key(paths).alias(key_col))
        frames.append(raw.select(*cols))
    return union_by_name(frames)


def read_months(spark: SparkSession, paths: Sequence[str], schema: StructType = TRIP_SCHEMA,
                key_col: str | None = None) -> DataFrame:
    """Per-path load, cast to ``schema``, then union by name keeping
    duplicates (S3, U1): one frame per monthly path, as the study's cluster
    job does. :func:`read_reconciled` is the same result with one scan per
    distinct footer schema; this form keeps one scan per path, which lets a
    caller add per-month columns or filters before the union."""
    frames = []
    for p in paths:
        raw = spark.read.parquet(p)
        cols = conform_columns(raw, schema)
        if key_col:
            cols.append(file_row_key(paths).alias(key_col))
        frames.append(raw.select(*cols))
    return union_by_name(frames)


def month_paths(base: str, year: int, months: Iterable[int] = range(1, 13),
                pattern: str = "yellow_tripdata_{year}-{month:02d}.parquet") -> list[str]:
    """Monthly file paths under any Hadoop file-system base URI."""
    base = base if base.endswith("/") else base + "/"
    return [base + pattern.format(year=year, month=m) for m in months]
