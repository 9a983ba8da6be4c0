"""Incremental ETL of exports dropped into a folder (Structured Streaming).

The analysed pipeline has no data streams; its input is an uploaded export.
Here the same conform + clean operators run on a file-source stream, so new
exports landing in a folder are cleaned as they arrive and appended to the
clean dataset (exactly once, via the sink's checkpoint). The row-level ETL is
stateless, so no watermark or state store is needed.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from loanlens.config import RiskConfig
from loanlens.operators.clean import clean_conformed, clean_dataset
from loanlens.sources.profiles import get_profile
from loanlens.sources.raw import csv_header, read_exports


def stream_clean(spark: SparkSession, input_dir: str, profile: str = "banner",
                 cfg: RiskConfig = RiskConfig(), max_files_per_trigger: int = 100,
                 header: list[str] | None = None) -> DataFrame:
    """Streaming clean dataset over CSV exports arriving in ``input_dir``.

    ``header`` is the exports' header line; without it, that of the files
    already there (or the profile's own, for an empty folder). Columns may come
    in any order, but all files of a stream share it: a file with another
    header fails the stream rather than being read into the wrong columns.
    """
    prof = get_profile(profile)
    names = header or csv_header(spark, input_dir) or prof.expected_columns
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    raw = (spark.readStream.schema(schema).option("header", True).option("enforceSchema", False)
           .option("quote", '"').option("escape", '"').option("multiLine", True)
           .option("maxFilesPerTrigger", max_files_per_trigger).csv(input_dir))
    return clean_dataset(raw, prof, cfg)


def start_clean_sink(clean: DataFrame, output_dir: str, checkpoint: str,
                     available_now: bool = True) -> StreamingQuery:
    """Append the cleaned rows to a parquet folder; progress in ``checkpoint``.

    ``checkpoint`` must be on shared storage on a cluster (for example under
    the session's ``spark.checkpoint.dir``).
    """
    w = (clean.writeStream.format("parquet").outputMode("append")
         .option("path", output_dir).option("checkpointLocation", checkpoint))
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()


def start_mixed_sink(spark: SparkSession, input_dir: str, output_dir: str, checkpoint: str, profile: str = "banner",
                     cfg: RiskConfig = RiskConfig(), max_files_per_trigger: int = 100,
                     available_now: bool = True) -> StreamingQuery:
    """Clean exports as they arrive, whose headers may differ in order, spelling and further columns.

    Every micro-batch groups its files by header (``read_exports``) and writes
    its clean rows to ``<output_dir>/batch=<number>``, replacing what an
    interrupted attempt at the same batch left, so a file counts once. A file
    that lacks a column of the profile fails the batch, by name.
    """
    prof = get_profile(profile)
    # the file source lists new files and remembers them; contents aren't read here
    files = (spark.readStream.format("binaryFile")
             .schema("path string, modificationTime timestamp, length long, content binary").option("maxFilesPerTrigger", max_files_per_trigger)
             .option("pathGlobFilter", "*.csv").load(input_dir).select("path"))

    def write(batch: DataFrame, number: int) -> None:
        paths = [r["path"] for r in batch.collect()]      # at most max_files_per_trigger
        if paths:
            clean = clean_conformed(read_exports(batch.sparkSession, paths, prof), prof, cfg)
            clean.write.mode("overwrite").parquet(f"{output_dir.rstrip('/')}/batch={number}")

    w = files.writeStream.foreachBatch(write).option("checkpointLocation", checkpoint)
    return (w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")).start()
