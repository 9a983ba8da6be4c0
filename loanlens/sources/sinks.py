"""Sinks: clean dataset (S3), segment report CSV (S5), result tables (S6),
fitted model (S7). All writes are distributed DataFrame / ML writers into a
directory per output; nothing is gathered on the driver.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from loanlens.operators.training import RiskModel

# Column headers of the segment report file (fixed values).
REPORT_HEADERS = (("segment", "Segment"), ("value", "Value"), ("n", "n"),
                  ("defaults", "Defaults"), ("default_rate_text", "Default Rate"))


def write_clean(clean: DataFrame, path: str, fmt: str = "parquet") -> None:
    """S3: the fixed 17-column dataset (parquet by default, CSV optional)."""
    w = clean.write.mode("overwrite")
    if fmt == "csv":
        w.option("header", True).csv(path)
    else:
        w.parquet(path)


def write_segment_report(report: DataFrame, path: str) -> None:
    """Segment, Value, n, Defaults, Default Rate (percent text), in report order."""
    out = report.orderBy("seg_pos", F.desc_nulls_last("default_rate"), F.desc("n"), "value")
    out.select(*[F.col(c).alias(h) for c, h in REPORT_HEADERS]).write.mode(
        "overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "json") -> None:
    """One result table as a directory of JSON lines (or parquet)."""
    df.write.mode("overwrite").format(fmt).save(path)


def write_model(model: RiskModel, path: str) -> None:
    """The refitted best model (preparation, classifier, categories) as tables below one folder."""
    model.save(path)
