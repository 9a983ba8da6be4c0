"""Preference formatting of chosen and rejected conversations (op 2).

DataFrame functions only. A pair's longest common turn prefix is the smallest
turn index at which the two sides differ (role or text, by a 128-bit digest,
or one side has ended), a partial min-aggregate over (pair, index). The prefix is rendered once
as prompt; the rest of each side becomes its completion, with the character
ranges that carry loss: the text and end mark of assistant turns.

Scale: turns stay rows until the final rendering, so comparing is spread over
(pair, index) even for very long conversations; only the rendered strings of
one pair, which are the result, meet in one row.

Edge cases: turns go by turn number, then role and text (nulls last); a null
role renders as ``unknown`` and a null text as empty; equal nulls are equal
turns; turns without a conversation id are ignored; repeated turns are turns;
a pair with one side missing has an empty prompt and an empty other
completion, one without any turn has three empty texts; empty tables give an empty result; other columns are ignored.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


@dataclass(frozen=True)
class ChatTemplate:
    """Marks around a turn: ``begin`` role ``after_role`` text ``end``."""

    begin: str = "<|start|>"
    after_role: str = "\n"
    end: str = "<|end|>\n"
    loss_role: str = "assistant"


def neighbour_pairs(conversations: DataFrame) -> DataFrame:
    """(pair_id, chosen_id, rejected_id): conversations 2k and 2k + 1 are the two sides of pair k."""
    ids = conversations.where("conv_id is not null").select(F.col("conv_id").cast("long").alias("conv_id")).distinct()
    even = F.pmod("conv_id", F.lit(2)) == 0
    return ids.groupBy(F.floor(F.col("conv_id") / 2).alias("pair_id")).agg(
        F.max(F.when(even, F.col("conv_id"))).alias("chosen_id"),
        F.max(F.when(~even, F.col("conv_id"))).alias("rejected_id"))


def format_preferences(pairs: DataFrame, conversations: DataFrame,
                       template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """One row per pair: ids, n_common, prompt, chosen, rejected and their loss ranges.

    ``chosen_loss`` and ``rejected_loss`` are arrays of (start, end) code
    points within the completion.
    """
    turns = conversations.where("conv_id is not null").select(
        F.col("conv_id").cast("long").alias("conv_id"), "turn", "role", "text",
        (F.row_number().over(Window.partitionBy("conv_id").orderBy(
            F.col("turn").asc_nulls_last(), F.col("role").asc_nulls_last(), F.col("text").asc_nulls_last())) - 1
         ).alias("idx"))
    sides = pairs.select("pair_id", F.explode(F.array(
        F.struct(F.lit(0).alias("side"), F.col("chosen_id").alias("conv_id")),
        F.struct(F.lit(1).alias("side"), F.col("rejected_id").alias("conv_id")))).alias("s")).select("pair_id", "s.*")
    rows = sides.join(turns, "conv_id")
    # two 64-bit digests stand for a turn, so comparing moves no text
    turn = [F.col("role").isNull(), "role", F.col("text").isNull(), "text"]
    digest = F.struct(F.xxhash64(F.lit(0), *turn).alias("a"), F.xxhash64(F.lit(1), *turn).alias("b"))
    differs = (F.count("*") < 2) | (F.min("digest") != F.max("digest"))
    common = (rows.select("pair_id", "idx", digest.alias("digest"))
              .groupBy("pair_id", "idx").agg(differs.alias("differs"))
              .groupBy("pair_id").agg(F.coalesce(
                  F.min(F.when(F.col("differs"), F.col("idx"))), F.max("idx") + 1).alias("n_common")))

    head = F.concat(F.lit(template.begin), F.coalesce("role", F.lit("unknown")), F.lit(template.after_role))
    tail = F.concat(F.coalesce("text", F.lit("")), F.lit(template.end))
    part = (F.when((F.col("idx") < F.col("n_common")) & (F.col("side") == 0), "prompt")
            .when(F.col("idx") < F.col("n_common"), None)
            .when(F.col("side") == 0, "chosen").otherwise("rejected"))
    before = Window.partitionBy("pair_id", "part").orderBy("idx").rowsBetween(Window.unboundedPreceding, -1)
    pieces = (rows.join(common, "pair_id").withColumn("part", part).where("part is not null")
              .withColumn("piece", F.concat(head, tail))
              .withColumn("at", F.coalesce(F.sum(F.char_length("piece")).over(before), F.lit(0)))
              .withColumn("loss", F.when(F.col("role") == template.loss_role, F.struct(
                  (F.col("at") + F.char_length(head)).alias("start"),
                  (F.col("at") + F.char_length("piece")).alias("end")))))

    def text_of(name: str):
        listed = F.sort_array(F.collect_list(F.when(F.col("part") == name, F.struct("idx", "piece"))))
        return F.array_join(F.transform(listed, lambda x: x["piece"]), "").alias(name)

    def loss_of(name: str):
        return F.sort_array(F.collect_list(F.when(F.col("part") == name, F.col("loss")))).alias(f"{name}_loss")

    done = pieces.groupBy("pair_id").agg(
        F.max("n_common").alias("n_common"), text_of("prompt"), text_of("chosen"), text_of("rejected"),
        loss_of("chosen"), loss_of("rejected"))
    found = pairs.join(done, "pair_id", "left")
    empty = F.array().cast(done.schema["chosen_loss"].dataType)
    return found.select(
        "pair_id", "chosen_id", "rejected_id", F.coalesce("n_common", F.lit(0)).alias("n_common"),
        *[F.coalesce(c, F.lit("")).alias(c) for c in ("prompt", "chosen", "rejected")],
        *[F.coalesce(c, empty).alias(c) for c in ("chosen_loss", "rejected_loss")])


def preference_report(pairs: DataFrame, conversations: DataFrame, template: ChatTemplate = ChatTemplate()) -> DataFrame:
    """:func:`format_preferences` with the loss ranges as ``start:end`` lists."""
    def listed(col: str):
        return F.array_join(F.transform(col, lambda s: F.concat_ws(
            ":", s["start"].cast("string"), s["end"].cast("string"))), ",").alias(col)

    out = format_preferences(pairs, conversations, template)
    return out.select("pair_id", "chosen_id", "rejected_id", F.col("n_common").cast("long").alias("n_common"),
                      "prompt", "chosen", "rejected", listed("chosen_loss"), listed("rejected_loss"))
