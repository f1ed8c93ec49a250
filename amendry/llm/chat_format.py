"""Chat formatting by multi-party perspective rotation.

Every dialogue is rendered once for each participant: that speaker is the assistant, all
others are users with their names, and only the assistant's words count for training. A
rendering is a list of segments, one per turn, with their places in the rendered text; the
segments joined in order of `seq` are the rendering itself.

Places are running sums over a dialogue, which may be of any length. Turns are sorted
over the whole table into ranges that may cut a dialogue. Sums run turn by turn inside a
range only; what earlier ranges hold of a dialogue is one sum for each range and
participant, so no dialogue is gathered in one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from amendry.sources.workspace import Workspace

SYSTEM = "system"  # speaks to all and takes no part
START, LINE, END = "<|im_start|>", "\n", "<|im_end|>\n"  # fixed values: the frame of a turn
DIALOGUE = ["_none", "_conv"]  # null is a dialogue of its own


def _head(speaker: Column, me: Column) -> Column:
    """Beginning of a turn: its role, and the name of a user."""
    role = (
        F.when(speaker == SYSTEM, F.lit(SYSTEM))
        .when(speaker == me, F.lit("assistant"))
        .otherwise(F.concat(F.lit("user name="), speaker))
    )
    return F.concat(F.lit(START), role, F.lit(LINE))


def _long(text: Column) -> Column:
    return F.char_length(text).cast("long")


def _sorted_ranges(turns: DataFrame, work: Workspace) -> DataFrame:
    """turns + the range they lie in and their place in it; staged, so both stay as they are."""
    order = [*DIALOGUE, F.col("turn").asc_nulls_first(), "_hash", "_part"]
    keyed = turns.withColumns({"_hash": F.xxhash64("speaker", "text"), "_part": F.spark_partition_id()})
    placed = keyed.repartitionByRange(*order).sortWithinPartitions(*order).drop("_hash", "_part")
    return work.stage(placed.withColumns({"range": F.spark_partition_id(), "at": F.monotonically_increasing_id()}), "turns")


def _before(turns: DataFrame) -> DataFrame:
    """(dialogue, me, range, n_before, size_before): turns and code points of a rendering in earlier ranges."""
    size = F.sum(_long(F.col("text")) + len(END))
    held = turns.groupBy(*DIALOGUE, "range", "speaker").agg(F.count("*").alias("n"), size.alias("size"))
    people = held.filter(F.col("speaker") != SYSTEM).select(*DIALOGUE, F.col("speaker").alias("me")).distinct()
    heads = F.col("n") * _long(_head(F.col("speaker"), F.col("me")))
    sums = held.join(people, DIALOGUE).groupBy(*DIALOGUE, "me", "range")
    sums = sums.agg(F.sum("n").alias("n"), F.sum(F.col("size") + heads).alias("size"))
    earlier = Window.partitionBy(*DIALOGUE, "me").orderBy("range").rowsBetween(Window.unboundedPreceding, -1)
    return sums.select(
        *DIALOGUE, "me", "range", *[F.coalesce(F.sum(c).over(earlier), F.lit(0)).alias(f"{c}_before") for c in ("n", "size")]
    )


def rotate(
    df: DataFrame, conv: str = "conv_id", turn: str = "turn", speaker: str = "role", text: str = "text"
) -> DataFrame:
    """One row per dialogue, participant and turn of the dialogue.

    Columns: conv_id, participant (whose perspective it is), seq (turns from 0), role, name
    (of a user), segment (the turn as rendered), start and stop (its code points in the
    rendering, stop exclusive), train_start and train_stop (the words the assistant is to
    learn; null for the turns of others).

    Turns are ordered by `turn`, nulls first, then by a hash of speaker and text; repeated
    rows stay repeated. A null speaker is "unknown", a null text is empty, and null is a
    dialogue of its own. A dialogue of system turns only has no participant and is not
    rendered. Other columns are not read; an empty table gives no rows; texts of any length
    are rendered whole. Ids of dialogues and turns are taken as long. Texts are given as they
    are: one that holds the marks of a turn puts them into the rendering, so texts from
    unknown sources should be cleaned of them before.
    """
    work = Workspace(df.sparkSession)
    turns = df.select(
        F.col(f"`{conv}`").isNull().cast("int").alias("_none"),
        F.coalesce(F.col(f"`{conv}`").cast("long"), F.lit(0)).alias("_conv"),
        F.col(f"`{turn}`").cast("long").alias("turn"),
        F.coalesce(F.col(f"`{speaker}`").cast("string"), F.lit("unknown")).alias("speaker"),
        F.coalesce(F.col(f"`{text}`"), F.lit("")).alias("text"),
    )
    turns = _sorted_ranges(turns, work)
    rows = turns.join(_before(turns), [*DIALOGUE, "range"])
    who, me = F.col("speaker"), F.col("me")
    rows = rows.withColumns({"head": _head(who, me), "segment": F.concat(_head(who, me), "text", F.lit(END))})
    inside = Window.partitionBy(*DIALOGUE, "me", "range").orderBy("at")
    sofar = F.coalesce(F.sum(_long(F.col("segment"))).over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    rows = rows.withColumns({"seq": F.col("n_before") + F.row_number().over(inside) - 1, "start": F.col("size_before") + sofar})
    rows = rows.withColumns({"stop": F.col("start") + _long(F.col("segment")), "own": (who == me) & (who != SYSTEM)})
    return rows.select(
        F.when(F.col("_none") == 0, F.col("_conv")).alias("conv_id"),
        me.alias("participant"),
        F.col("seq").cast("long").alias("seq"),
        F.when(who == SYSTEM, SYSTEM).when(F.col("own"), "assistant").otherwise("user").alias("role"),
        F.when((who != SYSTEM) & ~F.col("own"), who).alias("name"),
        "segment",
        "start",
        "stop",
        F.when(F.col("own"), F.col("start") + _long(F.col("head"))).alias("train_start"),
        F.when(F.col("own"), F.col("stop") - len(END)).alias("train_stop"),
    )
