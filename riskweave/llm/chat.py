"""Multi-party chat formatting by perspective rotation.

For every participant of a dialogue the dialogue is rendered once with that
speaker as the assistant, system turns as system turns, and all other speakers
as users named by their role. The masks are the character spans that a model
should learn: what the assistant of that rendering says, with its end mark.

A rendering comes in parts of ``block`` turn numbers (part = turn / block), in
order; spans count from the start of their part. So a dialogue of any length is
spread over tasks, and short dialogues are one part. DataFrame functions only.

Edge cases: a null role speaks as "unknown"; a null text is empty; null turns
come first, in part 0 with an own order by role and text, as do repeated turn
numbers; rows of a null conv_id are one dialogue; a dialogue of system turns
only has no participant and so no rendering; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

SYSTEM, UNKNOWN, END = "system", "unknown", "<|end|>"


def rotate(turns: DataFrame, block: int = 256) -> DataFrame:
    """conv_id, perspective, part, n_turns, text, spans of every rendering.

    ``turns``: conv_id, turn, role, text. ``spans`` is an array of (start, stop)
    in characters.
    """
    said = turns.select("conv_id", "turn", F.coalesce("role", F.lit(UNKNOWN)).alias("role"),
                        F.coalesce("text", F.lit("")).alias("said"),
                        F.coalesce(F.floor(F.col("turn") / block), F.lit(0)).cast("long").alias("part"))
    # Speakers of a dialogue: pre-aggregated before the shuffle, whatever the dialogue's length.
    speakers = said.filter(F.col("role") != SYSTEM).select("conv_id", F.col("role").alias("perspective")).distinct()
    speakers = speakers.withColumnRenamed("conv_id", "of")
    seen = said.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    own = F.col("role") == F.col("perspective")
    head = (F.when(F.col("role") == SYSTEM, F.lit("<|system|>\n")).when(own, F.lit("<|assistant|>\n"))
            .otherwise(F.concat(F.lit("<|user name="), F.col("role"), F.lit("|>\n"))))
    drawn = seen.withColumn("own", own).withColumn("head", head).withColumn(
        "piece", F.concat("head", "said", F.lit(END + "\n")))
    order = Window.partitionBy("conv_id", "perspective", "part").orderBy(
        F.col("turn").asc_nulls_first(), "role", "said")
    # sum() adds the pieces before a row; its default frame would merge equal rows.
    rows = order.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    placed = (drawn.withColumn("nth", F.row_number().over(order))
              .withColumn("stop", F.sum(F.length("piece")).over(rows) - 1)  # without the line break after the end mark
              .withColumn("start", F.col("stop") + 1 - F.length("piece") + F.length("head")))
    span = F.when(F.col("own"), F.struct(F.col("start").cast("long").alias("start"), F.col("stop").cast("long").alias("stop")))
    parts = placed.groupBy("conv_id", "perspective", "part").agg(
        F.count("*").alias("n_turns"), F.array_sort(F.collect_list(F.struct("nth", "piece"))).alias("pieces"),
        F.array_sort(F.collect_list(span)).alias("spans"))
    return parts.select("conv_id", "perspective", "part", "n_turns",
                        F.array_join(F.col("pieces.piece"), "").alias("text"), "spans")
