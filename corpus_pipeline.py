"""Corpus pipeline over ``documents``: filter, deduplicate, decontaminate, mix.

Each stage takes (spark, docs, sf_dir), works on all rows its predecessor kept
and returns a DataFrame; :func:`run` stores every result and rereads it, so a
lost executor costs at most one stage. All stages but the last return the
columns of ``documents`` unchanged.

Edge cases: decisions are made per (id, text), so an id that stands on several
texts loses just the ones that a stage rejects. Of equal texts the largest id
stays; a null id loses against any id, and of rows that repeat an id (or its
absence) and a text one stays. The near-duplicate and decontamination stages
number such rows themselves (``with_row_ids``): null and shared ids come after
all others, so they lose against unique ids.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from loanlens.llm.common import save_table, ship_package, text_digest, with_row_ids
from loanlens.llm.decontam import contamination
from loanlens.llm.exact_dedup import exact_duplicates
from loanlens.llm.jaccard_join import similarity_classes
from loanlens.llm.mixing import mix_sources
from loanlens.llm.toxicity import fit_chain, reject_toxic


def _without(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """Rows of ``docs`` (with their number ``_row``) whose number is not among the dropped ones."""
    gone = dropped.select(F.col("doc_id").alias("_row")).distinct().hint("shuffle_hash")
    return docs.join(gone, "_row", "left_anti").drop("_row")


def _by_row(docs: DataFrame) -> DataFrame:
    """The documents under their row numbers, for operators that go by doc_id."""
    return docs.select(F.col("_row").alias("doc_id"), "text")


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the classifier chain rejects go; the rest stays."""
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return reject_toxic(docs, fit_chain(docs, labels))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One row of each group of equal texts stays (the largest doc_id)."""
    found = exact_duplicates(docs).where("group_size > 1")
    gone = found.where("not kept").select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")).distinct()
    same = F.col("doc_id").eqNullSafe(F.col("_id")) & (text_digest() == F.col("_sha"))
    kept = docs.join(gone.hint("shuffle_hash"), same, "left_anti")
    # rows of one id and text that all stayed: keep the first of them
    again = save_table(found.where("kept").groupBy("doc_id", "text_sha256").agg(F.count("*").alias("n")).where("n > 1")
                       .select(F.col("doc_id").alias("_id"), F.col("text_sha256").alias("_sha")), "repeated-rows")
    if again.isEmpty():
        return kept
    kept = save_table(kept, "kept-rows")
    single = kept.join(again, same, "left_anti")
    return single.union(kept.join(again, same, "left_semi").dropDuplicates(["doc_id", "text"]))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group linked at 5-word Jaccard >= 0.8 stays (the smallest doc_id)."""
    docs = with_row_ids(docs)
    return _without(docs, similarity_classes(_by_row(docs), words=5, threshold=80).where("doc_id <> component_id"))


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold ten consecutive words of a benchmark item (or a whole shorter item) go."""
    benchmark = spark.read.parquet(f"{sf_dir}/benchmark.parquet")
    docs = with_row_ids(docs)
    return _without(docs, contamination(_by_row(docs), benchmark).where("contaminated"))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """How many words the mix takes of each document, by the golden-ratio schedule."""
    return mix_sources(docs)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact dedup", drop_exact_copies),
    ("n-gram Jaccard join", drop_near_copies),
    ("benchmark decontamination", drop_contaminated),
    ("mixing sources", mix),
]

#: The trained toxicity stage has no SQL form.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result is stored and reread."""
    ship_package(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = save_table(stage(spark, docs, sf_dir), "pipeline-" + name.replace(" ", "-"))
    return docs
