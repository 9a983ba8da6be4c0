"""Mixing sources to target weights by a low-discrepancy schedule (op 4).

Targets: sources in code-point order (null last) weigh ``weights`` in turn and
share ``share`` times all words; a target stops at ``max_repeats`` times its
source's words and the excess goes to the others by weight (water filling, in
closed form over the sources sorted by limit per weight).

Schedule: slot i takes the golden-ratio point ``frac(i * A / 2**31)`` through
the cumulative target shares to its source; there is one slot per
``block_words`` words of the goal. Slots are ranked within their source. A
source's stream is its documents in md5 order of (id, seed), read over and over;
its target, to the nearest word, is cut into as many equal blocks as it has
slots (equal to one word), and rank r reads block r. So every source comes to
its target whatever its size: the points settle the order of the slots and how
many blocks a source is dealt in, and the block length makes up for the points'
discrepancy. A source that no point has reached has one slot at the end. No
word is read more than ``max_repeats`` times, as no target is above that many
readings of the stream.

Scale: one row per slot, per block piece and per source; blocks and documents
meet in cells of a block's length. Ranks and stream
offsets are two-level prefix sums (counts per chunk, running sums over chunks,
positions within a chunk), so a source with a third of all rows is spread over
many partitions. There are about as many chunks as rows in one (the square
root of their number), so neither level grows out of a task.

Edge cases: null or empty text counts 0 words and is taken 0; null sources are
one source, last; null ids mix like others; repeated rows are separate
documents; an empty table gives an empty result; other columns are ignored.
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import save_table

WORD = r"[^\x20\x09\x0A\x0B\x0C\x0D]+"
#: Odd integer next to 2**31 / golden ratio: the step of the slot points.
STEP = 1_327_217_885
POINTS = 1 << 31
_LANES = 4_096


def source_targets(sizes: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                   max_repeats: int = 2) -> DataFrame:
    """(src, source, source_size, target, share_low, share_high) from rows (source, size)."""
    per = sizes.groupBy("source").agg(F.sum("size").cast("long").alias("source_size"))
    turn = F.row_number().over(Window.orderBy(F.col("source").asc_nulls_last())) - 1
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.col("src") % len(weights) + 1).cast("int"))
    per = per.withColumn("src", turn).withColumn("w", w).withColumn(
        "limit", (F.col("source_size") * max_repeats).cast("double"))
    everyone = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rank = [(F.col("limit") / F.col("w")).asc(), F.col("src").asc()]
    before = Window.orderBy(*rank).rowsBetween(Window.unboundedPreceding, -1)
    per = (per.withColumn("goal", F.sum(F.col("source_size").cast("double")).over(everyone) * share)
           .withColumn("all_w", F.sum("w").over(everyone))
           .withColumn("full", F.coalesce(F.sum("limit").over(before), F.lit(0.0)))
           .withColumn("full_w", F.coalesce(F.sum("w").over(before), F.lit(0.0)))
           # level if all sources before this one are at their limit and none after is
           .withColumn("level", (F.col("goal") - F.col("full")) / (F.col("all_w") - F.col("full_w")))
           .withColumn("open_level", F.when(F.col("level") * F.col("w") <= F.col("limit"), F.col("level"))))
    # the first source (by limit per weight) that its level leaves below its limit sets the level
    first_open = F.first("open_level", ignorenulls=True).over(
        Window.orderBy(*rank).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing))
    per = (per.withColumn("final", first_open)
           .withColumn("target", F.least(F.col("limit"), F.coalesce(F.col("final") * F.col("w"), F.col("limit")))))
    by_src = Window.orderBy("src")
    high = F.sum("target").over(by_src.rowsBetween(Window.unboundedPreceding, 0)) / F.col("goal")
    low = F.coalesce(F.sum("target").over(by_src.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)) / F.col("goal")
    return per.select("src", "source", "source_size", "target",
                      F.when(F.col("goal") > 0, low).alias("share_low"),
                      F.when(F.col("goal") > 0, high).alias("share_high"))


def schedule(targets: DataFrame, goal_words: float, block_words: int) -> DataFrame:
    """(slot, src, pick): the source of every slot and the slot's rank within it."""
    spark = targets.sparkSession
    slots = int(round(goal_words / block_words))
    per_chunk = math.isqrt(slots) + 1
    lanes = max(_LANES, 2 * targets.count())
    lane = lambda u: F.floor(u * lanes).cast("long")
    last = Window.orderBy("src").rowsBetween(1, Window.unboundedFollowing)
    shares = targets.where("target > 0").withColumn(  # rounding never leaves a gap at 1
        "share_high", F.when(F.count("*").over(last) == 0, F.lit(1.0)).otherwise(F.col("share_high")))
    bounds = shares.select("src", "share_low", "share_high", F.explode(F.sequence(
        lane(F.col("share_low")), F.least(lane(F.col("share_high")), F.lit(lanes - 1)))).alias("lane"))
    point = (F.col("slot") % POINTS * STEP % POINTS) / F.lit(float(POINTS))
    placed = (spark.range(slots).withColumnRenamed("id", "slot").withColumn("point", point)
              .withColumn("lane", lane(F.col("point")))
              .join(bounds, "lane").where("point >= share_low and point < share_high")
              .select("slot", "src", F.floor(F.col("slot") / per_chunk).alias("chunk")))
    counts = save_table(placed.groupBy("src", "chunk").count(), "mix-chunks")
    starts = counts.select("src", "chunk", F.coalesce(F.sum("count").over(
        Window.partitionBy("src").orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("begin"))
    inside = F.row_number().over(Window.partitionBy("src", "chunk").orderBy("slot")) - 1
    ranked = (placed.withColumn("inside", inside).join(starts, ["src", "chunk"])
              .select("slot", "src", (F.col("begin") + F.col("inside")).cast("long").alias("pick")))
    missed = shares.join(counts.select("src").distinct(), "src", "left_anti").select(
        (F.lit(slots) + F.col("src")).cast("long").alias("slot"), "src", F.lit(0).cast("long").alias("pick"))
    return ranked.union(missed)


def blocks_read(slots: DataFrame, targets: DataFrame) -> DataFrame:
    """(src, begin, end, cell_words): the piece of its source's stream that every slot reads.

    A block that runs over the end of the stream is one row per reading.
    """
    dealt = slots.groupBy("src").agg(F.count("*").alias("blocks"))
    # a row per source, stored, so that Spark knows its size and needn't deal the slots by source
    sizes = save_table(targets.select("src", "source_size", F.floor(F.col("target") + 0.5).cast("long").alias("words"))
                       .join(dealt, "src"), "mix-blocks")
    edge = lambda r: F.expr(f"cast({r} as decimal(20,0)) * words div blocks")
    cut = slots.join(sizes.withColumn("cell_words", F.ceil(F.col("words") / F.col("blocks"))), "src").select(
        "src", "source_size", "cell_words", edge("pick").alias("lo"), edge("(pick + 1)").alias("hi")).where("lo < hi")
    turn = F.explode(F.sequence(F.expr("lo div source_size"), F.expr("(hi - 1) div source_size")))
    shift = F.col("turn") * F.col("source_size")
    return cut.withColumn("turn", turn).select(
        "src", F.greatest(F.col("lo") - shift, F.lit(0)).alias("begin"),
        F.least(F.col("hi") - shift, F.col("source_size")).alias("end"), "cell_words")


def _cells(begin: str, end: str):
    """The cells of ``cell_words`` words that begin..end touches."""
    return F.explode(F.sequence(F.expr(f"{begin} div cell_words"), F.expr(f"({end} - 1) div cell_words"))).alias("cell")


def streams(docs: DataFrame, seed: str) -> DataFrame:
    """Documents (with src) at their first word's offset in their source's shuffled stream."""
    ranges = math.isqrt(docs.count()) + 1
    keyed = docs.withColumn("order", F.md5(F.concat(F.coalesce(F.col("doc_id").cast("string"), F.lit("")),
                                                    F.lit(":" + seed)).cast("binary")))
    keyed = keyed.withColumn("range", F.floor(
        F.conv(F.substring("order", 1, 8), 16, 10).cast("long") * ranges / F.lit(float(1 << 32))))
    sums = keyed.groupBy("src", "range").agg(F.sum("size").alias("words"))
    starts = sums.select("src", "range", F.coalesce(F.sum("words").over(
        Window.partitionBy("src").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)),
        F.lit(0)).alias("begin"))
    within = Window.partitionBy("src", "range").orderBy("order", "doc_id", "size").rowsBetween(
        Window.unboundedPreceding, -1)
    return (keyed.withColumn("inside", F.coalesce(F.sum("size").over(within), F.lit(0)))
            .join(starts, ["src", "range"])
            .withColumn("offset", F.col("begin") + F.col("inside")))


def mix_sources(docs: DataFrame, weights: tuple[int, ...] = (5, 2, 1), share: float = 1.5,
                max_repeats: int = 2, block_words: int = 64, seed: str = "mix") -> DataFrame:
    """One row per document: doc_id, source, size, source_size, target, taken."""
    sized = save_table(docs.select(
        "doc_id", F.col("source").cast("string").alias("source"),
        F.coalesce(F.regexp_count("text", F.lit(WORD)), F.lit(0)).cast("long").alias("size")), "mix-sizes")
    targets = save_table(source_targets(sized, weights, share, max_repeats), "mix-targets")
    rows = save_table(streams(
        sized.join(targets.withColumnRenamed("source", "of"), F.col("source").eqNullSafe(F.col("of"))).drop("of"),
        seed).select("doc_id", "source", "src", "size", "source_size", "target", "offset"), "mix-streams")
    goal = share * float(sized.agg(F.sum("size")).first()[0] or 0)

    reads = save_table(blocks_read(save_table(schedule(targets, goal, block_words), "mix-slots"), targets), "mix-reads")
    # what a source reads is the beginning of its stream, all of it if the target is that long
    upto = save_table(reads.groupBy("src").agg(F.max("end").alias("read"), F.max("cell_words").alias("cell_words")), "mix-read")
    pieces = (rows.join(upto, "src").withColumn("stop", F.least(F.col("offset") + F.col("size"), F.col("read")))
              .where("offset < stop").select("src", "offset", "stop", "cell_words", _cells("offset", "stop")))
    read_cells = reads.select("src", "begin", "end", _cells("begin", "end"))
    low = F.greatest("offset", "begin", F.col("cell") * F.col("cell_words"))
    high = F.least("stop", "end", (F.col("cell") + 1) * F.col("cell_words"))
    per_row = pieces.join(read_cells, ["src", "cell"]).groupBy("src", "offset").agg(
        F.sum(F.greatest(high - low, F.lit(0))).cast("long").alias("taken"))
    # rows with words have offsets of their own within a source
    return (rows.join(per_row, ["src", "offset"], "left")
            .select("doc_id", "source", "size", "source_size", "target",
                    F.when(F.col("size") > 0, F.coalesce("taken", F.lit(0))).otherwise(0).cast("long").alias("taken")))
