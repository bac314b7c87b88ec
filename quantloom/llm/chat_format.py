"""Chat formatting by perspective rotation.

Each participant of a dialogue in turn is the assistant: that speaker's turns are rendered as the
assistant's and carry the training mask, all others as those of named users. A dialogue is rendered turn
by turn, with each segment's place in the whole, so no dialogue is ever gathered in one row or task.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

BEGIN, END = "<|im_start|>", "<|im_end|>"
SYSTEM = "system"
CHUNK = 512  # turns whose places are summed up in one place


def rotate_perspectives(turns: DataFrame, begin: str = BEGIN, end: str = END) -> DataFrame:
    """A row for each turn and perspective: conv_id, perspective, seq, speaker, role, segment, start_at, end_at, mask_from, mask_until.

    ``turns(conv_id, turn, role, text)``: role names the speaker; ``system`` speaks for nobody and stays
    system. Segments in order of seq make up the whole dialogue; start_at and end_at are their places in it
    in characters, mask_from and mask_until the stretch that is trained on (text and end mark of the
    perspective's own turns; null elsewhere). Turns are ordered by turn, speaker and text, turns without
    number last; repeated rows are repeated turns. A null role speaks as ``unknown``, a null text is empty;
    null conv_ids make up one dialogue. A dialogue with no speaker but system has no perspective and no
    row. Marks inside a text or a name are broken by a space and line ends in a name are spaces, so neither
    can end a turn or start one; ``speaker`` and ``perspective`` are the names as they came. Other columns are ignored; an
    empty table gives no rows.
    """

    def unmarked(text):
        for mark in (begin, end):
            text = F.replace(text, F.lit(mark), F.lit(mark[0] + " " + mark[1:]))
        return text

    rows = turns.select(
        F.col("conv_id").cast("long").alias("conv_id"),
        F.col("turn").cast("long").alias("turn"),
        F.coalesce(F.col("role").cast("string"), F.lit("unknown")).alias("speaker"),
        unmarked(F.coalesce(F.col("text").cast("string"), F.lit(""))).alias("body"),
    )
    # equal rows are counted before anything meets by dialogue
    rows = rows.groupBy("conv_id", "turn", "speaker", "body").agg(F.count(F.lit(1)).alias("times"))
    rows = rows.withColumn("chunk", F.coalesce(F.floor(F.col("turn") / CHUNK), F.lit(2**62)))
    speakers = rows.where(F.col("speaker") != SYSTEM).select(F.col("conv_id").alias("of"), F.col("speaker").alias("perspective")).distinct()
    seen = rows.join(speakers, F.col("conv_id").eqNullSafe(F.col("of"))).drop("of")
    own = F.col("speaker") == F.col("perspective")
    role = F.when(own, "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise("user")
    head = F.concat(F.lit(begin), role, F.when(role == "user", F.concat(F.lit(" name="), unmarked(F.translate("speaker", "\r\n", "  ")))).otherwise(""), F.lit("\n"))
    seen = seen.withColumn("role", role).withColumn("head", head).withColumn("segment", F.concat("head", "body", F.lit(end + "\n")))
    seen = seen.withColumn("length", F.length("segment").cast("long"))
    # places: inside a chunk of turns, and of the chunk in the dialogue
    keys = ["conv_id", "perspective"]
    inside = Window.partitionBy(*keys, "chunk").orderBy(F.asc_nulls_last("turn"), "speaker", "body").rowsBetween(Window.unboundedPreceding, -1)
    before = Window.partitionBy(*keys).orderBy("chunk").rowsBetween(Window.unboundedPreceding, -1)
    chunks = seen.groupBy(*keys, "chunk").agg(F.sum(F.col("length") * F.col("times")).alias("l"), F.sum("times").alias("t"))
    chunks = chunks.select(F.col("conv_id").alias("c_"), F.col("perspective").alias("p_"), F.col("chunk").alias("k_"), F.coalesce(F.sum("l").over(before), F.lit(0)).alias("l0"), F.coalesce(F.sum("t").over(before), F.lit(0)).alias("t0"))
    seen = seen.withColumn("l1", F.coalesce(F.sum(F.col("length") * F.col("times")).over(inside), F.lit(0))).withColumn("t1", F.coalesce(F.sum("times").over(inside), F.lit(0)))
    placed = seen.join(chunks, F.col("conv_id").eqNullSafe(F.col("c_")) & (F.col("perspective") == F.col("p_")) & (F.col("chunk") == F.col("k_")))
    placed = placed.withColumn("copy", F.explode(F.sequence(F.lit(0).cast("long"), F.col("times") - 1)))
    start = F.col("l0") + F.col("l1") + F.col("copy") * F.col("length")
    return placed.select(
        "conv_id",
        "perspective",
        (F.col("t0") + F.col("t1") + F.col("copy")).alias("seq"),
        "speaker",
        "role",
        "segment",
        start.alias("start_at"),
        (start + F.col("length")).alias("end_at"),
        F.when(own, start + F.length("head")).alias("mask_from"),
        F.when(own, start + F.col("length") - 1).alias("mask_until"),
    )
