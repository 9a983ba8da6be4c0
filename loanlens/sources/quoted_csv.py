"""Quoted CSV in several tasks: records found by quote parity.

Spark can split a text file anywhere, but a line break inside quotes belongs to
its cell, so a task that starts in the middle of a file can't tell whether it
stands inside a quoted cell. Here

1. every split counts its quote characters (a grouped aggregate; doubled quotes
   cancel out), and the parity of all splits before it says how it begins,
2. every split then cuts its lines into records by the running parity: a record
   ends at a line break outside quotes. Pieces at a split's edges, of records
   that begin or end in another one, are put together per record.

So a file of any size is read by as many tasks as it has splits, in any store
that Spark reads. Files are grouped by their header row: each group is one
scan under its own column order, and the groups are united by column name.

Cells follow RFC 4180: a cell that holds a quote, comma or line break is
quoted, and quotes inside are doubled. An unquoted cell with a lone quote isn't
such a file; ``read_csv(multi_line=False)`` reads it line by line. A last cell
that is never closed ends with its file. Compressed files can't be split and
are one task each.
"""

from __future__ import annotations

import csv
from collections.abc import Iterator
from urllib.parse import unquote

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from loanlens.session import checkpoint_dir, ship_package

WHOLE, CLOSES, BETWEEN, OPENS = range(4)     # a record; the end, a middle piece, the beginning of one
#: Splits up to this number are joined to their lines by broadcast (a few bytes each), more by shuffle.
BROADCAST_SPLITS = 200_000


def _paths(files: list[str]) -> list[str]:
    """File names as the scan's metadata gives them (percent-encoded) back to paths."""
    return [unquote(f) for f in files]


def _lines(spark: SparkSession, paths: list[str]) -> DataFrame:
    return spark.read.option("lineSep", "\n").text(paths).select(
        "value", F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"))


def split_parity(spark: SparkSession, paths: list[str]) -> DataFrame:
    """(file, split, open, first): whether a split begins inside quotes, and its first line; stored."""
    lines = _lines(spark, paths).withColumn("at", F.monotonically_increasing_id())
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    per = lines.groupBy("file", "split").agg(
        (F.sum(quotes) % 2).alias("odd"), F.min_by("value", "at").alias("first"))
    before = Window.partitionBy("file").orderBy("split").rowsBetween(Window.unboundedPreceding, -1)
    opened = F.coalesce(F.sum("odd").over(before), F.lit(0)) % 2 == 1
    checkpoint_dir(spark)
    return per.select("file", "split", opened.alias("open"), "first").checkpoint(eager=True)


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Lines (in file order) to (file, split, place, kind, text); ``place`` is the first line's number in its split."""
    at, place, parity, held, begun, kind = None, 0, False, [], 0, WHOLE

    def out(rows: list[tuple]) -> pa.RecordBatch:
        file, split, places, kinds, texts = zip(*rows)
        return pa.RecordBatch.from_arrays(
            [pa.array(file, pa.string()), pa.array(split, pa.int64()), pa.array(places, pa.int64()),
             pa.array(kinds, pa.int32()), pa.array(texts, pa.string())], ["file", "split", "place", "kind", "text"])

    for batch in batches:
        rows = []
        odd = pc.bit_wise_and(pc.count_substring(batch.column(0), '"'), 1).to_pylist()
        for value, file, split, opened, flips in zip(
                batch.column(0).to_pylist(), batch.column(1).to_pylist(), batch.column(2).to_pylist(),
                batch.column(3).to_pylist(), odd):
            if (file, split) != at:
                if held:
                    rows.append((*at, begun, BETWEEN if kind == CLOSES else OPENS, "\n".join(held)))
                at, place, parity, held, kind = (file, split), 0, opened, [], CLOSES if opened else WHOLE
                begun = 0
            if not held:
                begun = place
            held.append(value)
            parity ^= bool(flips)
            place += 1
            if not parity:
                rows.append((file, split, begun, kind, "\n".join(held)))
                held, kind = [], WHOLE
        if rows:
            yield out(rows)
    if held:
        yield out([(*at, begun, BETWEEN if kind == CLOSES else OPENS, "\n".join(held))])


def csv_records(spark: SparkSession, paths: list[str], parity: DataFrame) -> DataFrame:
    """(file, split, place, record): all records of the files, header rows included, blank ones left out."""
    ship_package(spark)
    lines, starts = _lines(spark, paths), parity.select("file", "split", "open")
    if parity.count() <= BROADCAST_SPLITS:
        placed = lines.join(F.broadcast(starts), ["file", "split"])      # lines stay in order
    else:
        placed = (lines.withColumn("at", F.monotonically_increasing_id()).join(starts, ["file", "split"])
                  .repartition("file", "split").sortWithinPartitions("file", "split", "at"))
    pieces = placed.select("value", "file", "split", "open").mapInArrow(
        _cut, "file string, split long, place long, kind int, text string")
    whole = pieces.where(F.col("kind") == WHOLE).select("file", "split", "place", "text")
    # a record over several splits is known by the split that opens it
    edges = pieces.where(F.col("kind") != WHOLE)
    onwards = Window.partitionBy("file").orderBy("split", "kind").rowsBetween(Window.unboundedPreceding, 0)
    opener = F.last(F.when(F.col("kind") == OPENS, F.struct(F.col("split").alias("s"), F.col("place").alias("p"))),
                    ignorenulls=True).over(onwards)
    stitched = (edges.withColumn("by", opener).groupBy("file", "by.s", "by.p").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("split", "text"))), lambda x: x["text"]), "\n").alias("text"))
        .select("file", F.col("s").alias("split"), F.col("p").alias("place"), "text"))
    text = F.regexp_replace("text", "\r$", "")
    return whole.union(stitched).select("file", "split", "place", text.alias("record")).where(F.length("record") > 0)


def header_groups(spark: SparkSession, path: str | list[str]) -> tuple[list[tuple[list[str], list[str]]], DataFrame]:
    """([(header names, files)], parity of all splits): the files of a folder by their header row, as written."""
    parity = split_parity(spark, [path] if isinstance(path, str) else path)
    heads = parity.where("split = 0").groupBy("first").agg(F.collect_list("file").alias("files")).collect()
    groups: dict[tuple[str, ...], list[str]] = {}
    for row in heads:        # one row per spelling of the header row; the files are the scan's own listing
        if row["first"].count('"') % 2 == 0:
            groups.setdefault(_names(row["first"]), []).extend(row["files"])
            continue
        for file in row["files"]:     # a header cell with a line break
            record = csv_records(spark, _paths([file]), parity.where(F.col("file") == file)).where("split = 0 and place = 0").first()
            groups.setdefault(_names(record["record"]), []).extend([file])
    return [(list(names), sorted(files)) for names, files in sorted(groups.items())], parity


def _names(line: str) -> tuple[str, ...]:
    return tuple(next(csv.reader([line.removeprefix("﻿").rstrip("\r")]), []))


def read_group(spark: SparkSession, names: list[str], files: list[str], parity: DataFrame) -> DataFrame:
    """The rows of files with one header; every cell is text, empty unquoted cells are null."""
    fields = [f"_{k}" for k in range(len(names))]       # names that differ only in case can't share a schema
    schema = T.StructType([T.StructField(f, T.StringType()) for f in fields])
    rows = csv_records(spark, _paths(files), parity.where(F.col("file").isin(*files) if len(files) <= 1_000 else F.lit(True)))
    cells = rows.where("not (split = 0 and place = 0)").select(F.from_csv(
        "record", schema.simpleString()[7:-1].replace(":", " "), {"quote": '"', "escape": '"'}).alias("c"))
    return cells.select(*[F.col(f"c.{f}") for f in fields]).toDF(*names)
