"""Chat rendering with the perspective rotated: each participant once as the assistant.

For every participant of a conversation the dialogue is rendered with that participant's turns as the assistant's, all
other turns as those of named users, and system turns as they are. The mask of a turn is 1 where the assistant speaks:
its spans hold the text and the end mark, and nothing else is trained on.

The result has one row per participant and turn, so a conversation of any length is never gathered in one value: a row
holds the rendered turn, its place in the whole rendering and its span there. Joined in the order of ``position`` the
segments are the dialogue. Places come from running sums over slices and over the totals of the slices. A slice is what one
range of the whole table's order holds of a conversation, and of that at most ``SLICE`` turn numbers; so turns without a
number or with the same one are spread over slices as well. Equal turns of a conversation are counted first and counted
out at the end, so any number of them is one row on the way.

Turns are ordered by number (null first), ties by role, then text. A null role is named ``unknown``, a null text is empty, a row
without a conversation is left in a conversation of its own name (null). Repeated rows are repeated turns. A dialogue of
system turns alone has no participant and gives no rows. Role names are reduced to letters, digits, ``-`` and ``_``;
names that become equal are one participant.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from emberlog.llm.shared import stored

SLICE = 1024
#: Ranges of the order look at so many code points of a text, as samples of their bounds reach the driver.
BOUND = 64
#: Equal turns are counted out in blocks of so many.
BLOCK = 1024
START, END = "<|im_start|>", "<|im_end|>"


def rotated(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text"
) -> DataFrame:
    """(conv, participant, turn, position, segment, masked, segment_start, mask_start, mask_end) of each rendered turn.

    Starts and ends count code points of the whole rendering; mask_start and mask_end are null where nothing is trained.
    """
    turns = df.select(
        F.col(conv_col).alias("conv"),
        F.col(turn_col).alias("turn"),
        F.regexp_replace(F.coalesce(F.col(role_col), F.lit("unknown")), "[^\\p{L}\\p{N}_-]", "_").alias("role"),
        # Marks inside a text are no marks.
        F.regexp_replace(F.coalesce(F.col(text_col), F.lit("")), "<\\|(im_start|im_end)\\|>", "<|$1 |>").alias("text"),
    )
    order = ["turn", "role", "text"]
    counted = turns.groupBy("conv", *order).agg(F.count("*").alias("copies"))
    ranged = counted.repartitionByRange("conv", "turn", "role", F.substring("text", 1, BOUND))
    # Both parts of a slice's name grow with the order. The table keeps them as they are if a task is run again.
    sliced = ranged.withColumns({"range": F.spark_partition_id(), "span": F.floor(F.col("turn") / SLICE)})
    turns = stored(sliced, "chat")
    participants = (
        turns.filter("role <> 'system'").select(F.col("conv").alias("of"), F.col("role").alias("participant")).distinct()
    )
    views = turns.join(participants, turns["conv"].eqNullSafe(F.col("of"))).drop("of")
    speaks = F.col("role") == F.col("participant")
    name = (
        F.when(speaks, "assistant")
        .when(F.col("role") == "system", "system")
        .otherwise(F.concat(F.lit("user name="), F.col("role")))
    )
    head = F.concat(F.lit(START), name, F.lit("\n"))
    views = views.withColumns(
        {
            "masked": speaks,
            "head_size": F.char_length(head).cast("bigint"),
            "segment": F.concat(head, F.col("text"), F.lit(END + "\n")),
        }
    ).withColumn("size", F.char_length("segment").cast("bigint"))
    key, slice_of = ["conv", "participant"], ["range", "span"]
    within = Window.partitionBy(*key, *slice_of).orderBy(*order)
    upto = within.rowsBetween(Window.unboundedPreceding, Window.currentRow)
    copies, size = F.col("copies"), F.col("size")
    per_slice = views.groupBy(*key, *slice_of).agg(
        F.sum(size * copies).alias("slice_size"), F.sum(copies).alias("slice_turns")
    )
    earlier = Window.partitionBy(*key).orderBy(*slice_of).rowsBetween(Window.unboundedPreceding, -1)
    per_slice = per_slice.select(
        *(F.col(c).alias(f"s_{c}") for c in [*key, *slice_of]),
        F.coalesce(F.sum("slice_size").over(earlier), F.lit(0)).alias("size_before"),
        F.coalesce(F.sum("slice_turns").over(earlier), F.lit(0)).alias("turns_before"),
    )
    placed = views.withColumns(
        {"turns_here": F.sum(copies).over(upto) - copies, "size_here": F.sum(size * copies).over(upto) - size * copies}
    )
    same = [F.col(c).eqNullSafe(F.col(f"s_{c}")) for c in [*key, *slice_of]]
    placed = placed.join(per_slice, same[0] & same[1] & same[2] & same[3])
    blocks = F.sequence(F.lit(0), F.floor((copies - 1) / BLOCK).cast("bigint"))
    placed = placed.select("*", F.explode(blocks).alias("block"))
    first = F.col("block") * BLOCK
    placed = placed.select("*", F.explode(F.sequence(first, F.least(first + BLOCK, copies) - 1)).alias("copy"))
    start = F.col("size_before") + F.col("size_here") + F.col("copy") * size
    mask_start, mask_end = start + F.col("head_size"), start + size - 1
    return placed.select(
        *key,
        "turn",
        (F.col("turns_before") + F.col("turns_here") + F.col("copy") + 1).alias("position"),
        "segment",
        "masked",
        start.alias("segment_start"),
        F.when(F.col("masked"), mask_start).alias("mask_start"),
        F.when(F.col("masked"), mask_end).alias("mask_end"),
    )
