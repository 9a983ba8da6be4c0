"""Raw and clean table scans."""

from __future__ import annotations

from collections import Counter

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from loanlens.sources.quoted_csv import header_groups, read_group

ALLOWED_FORMATS = ("csv", "parquet", "json")


def format_of(path: str) -> str:
    """Lower-case suffix of the path's last segment; csv when it has none."""
    name = path.rstrip("/").rsplit("/", 1)[-1]
    fmt = name.rsplit(".", 1)[-1].lower() if "." in name else "csv"
    if fmt not in ALLOWED_FORMATS:
        raise ValueError(f"Unsupported export type {fmt!r}; readable: {', '.join(ALLOWED_FORMATS)}")
    return fmt


def _csv_reader(spark: SparkSession, multi_line: bool):
    # quotes are doubled inside quoted cells, as spreadsheets write them
    return spark.read.option("quote", '"').option("escape", '"').option("multiLine", multi_line)


def csv_header(spark: SparkSession, path: str, multi_line: bool = True) -> list[str]:
    """The first row of the (first) file, spelled as written."""
    row = _csv_reader(spark, multi_line).option("header", False).csv(path).first()
    return ["" if c is None else c for c in row] if row is not None else []


def read_csv(spark: SparkSession, path: str, multi_line: bool = True) -> DataFrame:
    """CSV export with every cell as text and the header exactly as written.

    Quoted cells may hold line breaks, and a file is still read by several tasks
    (:mod:`.quoted_csv`). Files of a folder may order their columns
    differently; files that don't have the same columns fail the read (a
    profile may unite them, see :func:`read_exports`). Headers that differ
    only in case stay two columns. ``multi_line=False`` takes every line for a
    row, for exports with lone quotes.
    """
    if not multi_line:
        return _read_lines(spark, path)
    groups, parity = header_groups(spark, path)
    if not groups:
        return spark.createDataFrame([], T.StructType([]))
    parts = [read_group(spark, names, files, parity) for names, files in groups]
    first = groups[0][0]
    for names, files in groups[1:]:
        if sorted(names) != sorted(first) or len(set(names)) < len(names):
            raise ValueError(f"header of {files[0]} has other columns than that of {groups[0][1][0]}: "
                             f"{', '.join(sorted(set(names) ^ set(first)))}")
    whole = parts[0]
    for part, (names, _) in zip(parts[1:], groups[1:]):     # by position: names may differ only in case
        at = {n: k for k, n in enumerate(names)}
        order = part.toDF(*[f"_{k}" for k in range(len(names))])
        whole = whole.union(order.select(*[f"_{at[n]}" for n in first]).toDF(*first))
    return whole


def read_exports(spark: SparkSession, path: str, profile) -> DataFrame:
    """P1-P4 on a folder whose files differ in header spelling, order and further columns.

    Every group of files with one header is conformed by itself; the profile's
    columns are united by canonical name. Headers missing from any group are
    reported together.
    """
    from loanlens.operators.conform import HeaderError, conform

    groups, parity = header_groups(spark, path)
    canonical = [c for _, c in profile.column_map]
    parts, problems = [], []
    for names, files in groups:
        try:
            parts.append(conform(read_group(spark, names, files, parity), profile).select(*canonical))
        except HeaderError as err:
            problems.append(f"{len(files)} file(s) such as {files[0]}: {err}")
    if problems or not parts:
        raise HeaderError("; ".join(problems) or f"no file in {path}")
    whole = parts[0]
    for part in parts[1:]:
        whole = whole.unionByName(part)
    return whole


def _read_lines(spark: SparkSession, path: str) -> DataFrame:
    names = csv_header(spark, path, False)
    reader = _csv_reader(spark, False).option("header", True)
    if max(Counter(n.lower() for n in names).values(), default=0) > 1:
        # such a header cannot be a Spark schema: read by position, name afterwards
        schema = T.StructType([T.StructField(f"_{k}", T.StringType()) for k in range(len(names))])
        return reader.schema(schema).csv(path).toDF(*names)
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    return reader.schema(schema).option("enforceSchema", False).csv(path)


def read_raw(spark: SparkSession, path: str, fmt: str | None = None, multi_line: bool = True) -> DataFrame:
    """Read a borrower export with every column as text.

    No schema inference: ids keep leading zeros and one bad cell cannot turn
    a column into something else. ``fmt`` defaults to the path's suffix.
    """
    fmt = format_of(f"x.{fmt}") if fmt else format_of(path)
    if fmt == "csv":
        return read_csv(spark, path, multi_line)
    if fmt == "json":
        df = spark.read.option("primitivesAsString", True).json(path)
    else:
        df = spark.read.parquet(path)
    return df.select([df[f"`{c}`"].cast("string").alias(c) for c in df.columns])


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def read_clean(spark: SparkSession, path: str) -> DataFrame:
    """The clean dataset written by the ETL sink, with its fixed schema."""
    from loanlens.operators.clean import CLEAN_SCHEMA

    return spark.read.schema(CLEAN_SCHEMA).parquet(path)
