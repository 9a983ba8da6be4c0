"""Exact duplicates by progressive refinement: length, prefix hash, full hash (op 7).

DataFrame functions only. One pass over the table takes each row's byte length,
a hash of its first characters and the digest of its whole text (every row's
digest is part of the result); no text leaves its task. Level 1 counts lengths,
level 2 splits the lengths that occur more than once by the prefix hash, and
only rows that still have company there are grouped by the full digest. Counts
are partial aggregates, so a length or text that holds a third of all rows
costs one row per task; rows get their group's size through
:func:`attach_groups`, which deals the rows of hot groups evenly.

Edge cases: a null text equals the empty text; nothing is normalised; rows
that repeat an id and a text are equal rows and all carry the same flags; null
ids lose against any id and keep each other when alone; an empty table gives
an empty result; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import attach_groups, save_table, text_digest

PREFIX_CHARS = 64


def refine(docs: DataFrame) -> tuple[DataFrame, DataFrame, int]:
    """(rows with their level keys, groups of equal texts, number of rows).

    Rows have ``doc_id, n_bytes, prefix, digest`` and no text; groups have the
    three keys, ``keep_id`` and ``group_size`` of two rows or more.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    rows = save_table(docs.select(
        "doc_id", F.octet_length(text).cast("long").alias("n_bytes"),
        F.xxhash64(F.substring(text, 1, PREFIX_CHARS)).alias("prefix"),
        F.unhex(text_digest()).alias("digest")), "dedup-rows")
    lengths = save_table(rows.groupBy("n_bytes").agg(F.count("*").alias("n")).where("n > 1"), "dedup-lengths")
    total = rows.count()
    company = attach_groups(rows, lengths, ["n_bytes"], "n", total).where("n is not null").drop("n")
    prefixes = save_table(company.groupBy("n_bytes", "prefix").agg(F.count("*").alias("n")).where("n > 1"), "dedup-prefixes")
    company = attach_groups(rows, prefixes, ["n_bytes", "prefix"], "n", total).where("n is not null")
    groups = (company.groupBy("n_bytes", "prefix", "digest")
              .agg(F.max("doc_id").alias("keep_id"), F.count("*").alias("group_size")).where("group_size > 1"))
    return rows, save_table(groups, "dedup-groups"), total


def exact_duplicates(docs: DataFrame) -> DataFrame:
    """One row per input row: doc_id, keep_id, group_size, kept, text_sha256.

    The row with the largest doc_id of equal texts stays.
    """
    rows, groups, total = refine(docs)
    return (attach_groups(rows, groups, ["n_bytes", "prefix", "digest"], "group_size", total)
            .select("doc_id",
                    F.when(F.col("group_size").isNull(), F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
                    F.coalesce("group_size", F.lit(1)).cast("long").alias("group_size"),
                    F.lower(F.hex("digest")).alias("text_sha256"))
            .withColumn("kept", F.col("doc_id").eqNullSafe(F.col("keep_id"))))
