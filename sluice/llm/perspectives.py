"""Multi-party dialogues as training text, once for every participant.

For each participant the dialogue is rendered with that speaker as the assistant and all others as
users with their names; system turns stay system turns. The mask marks what the assistant says, which
is what a model is to learn from that rendering.

All of it is DataFrame work. A dialogue of up to ``part_turns`` turns is one row a participant. A longer one is
cut into blocks by place: the turns whose number has from ``block * part_turns`` earlier turns on, up to the next block. Only of
one number may a block have more turns, and is then cut into parts; so no dialogue, however long, is gathered
in one row. Parts in the order of ``block`` and ``part`` give the whole.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from sluice.llm.common import materialise

SYSTEM = "system"
PART_TURNS = 512
#: Marks of the rendering. In names and texts ``<|`` becomes ``< |``, so that no turn can forge one.
OPEN, CLOSE = "<|", "<|end|>"


def blocks_of_long(rows: DataFrame, part_turns: int) -> DataFrame:
    """``of, at, block`` per conversation and turn number of ``rows`` (``conv_id, turn``), for conversations of more than ``part_turns`` turns.

    Written. Turns are counted by number first and summed in ranges of numbers, so no task meets a whole conversation.
    """
    number = rows.groupBy("conv_id", "turn").agg(F.count(F.lit(1)).alias("n"))
    number = number.select(F.col("conv_id").alias("of"), F.col("turn").alias("at"), F.floor(F.col("turn") / part_turns).alias("range"), "n")
    ranges = number.groupBy("of", "range").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy("of")
    before = F.sum("n").over(whole.orderBy("range")) - F.col("n")
    long = ranges.select("of", "range", before.alias("before"), F.sum("n").over(whole).alias("all")).filter(F.col("all") > part_turns)
    earlier = F.sum("n").over(Window.partitionBy("of", "range").orderBy("at")) - F.col("n")
    placed = number.select("of", "range", "at", earlier.alias("earlier")).alias("n")
    same = F.col("n.of").eqNullSafe(F.col("l.of")) & (F.col("n.range") == F.col("l.range"))
    joined = placed.join(long.alias("l"), same)
    block = F.floor((F.col("before") + F.col("earlier")) / part_turns)
    return materialise(joined.select("n.of", "at", block.alias("block")), "blocks")


def rotate(
    turns: DataFrame,
    part_turns: int = PART_TURNS,
    conv_col: str = "conv_id",
    turn_col: str = "turn",
    role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """``conv_id, speaker, block, part, n_turns, n_own, text, mask`` per dialogue, participant and part.

    ``mask`` lists the spans of ``text`` to learn from as ``start-end``, joined by commas, counted in code
    points, the end mark of a turn included. Participants are the roles of the dialogue but ``system``.
    Turns are ordered by number, of equal numbers by role and text; a NULL number is -1, a NULL text
    empty, and a NULL or empty role an unnamed user and no participant. A very long text is one turn. Repeated rows are turns
    each. Rows without conversation are one conversation. A dialogue without participants, and an
    empty table, give no rows. Other columns are not read.
    """
    safe = {c: F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit(OPEN), F.lit("< |")) for c in (role_col, text_col)}
    rows = turns.select(
        F.col(conv_col).alias("conv_id"),
        F.coalesce(F.col(turn_col).cast("bigint"), F.lit(-1)).alias("turn"),
        safe[role_col].alias("role"),
        safe[text_col].alias("said"),
    )
    known = blocks_of_long(rows.select("conv_id", "turn"), part_turns)
    long = rows.join(known, F.col("conv_id").eqNullSafe(F.col("of")) & (F.col("turn") == F.col("at")), "left").drop("of", "at")
    rows = long.withColumn("block", F.coalesce("block", F.lit(0).cast("bigint")))
    place = F.row_number().over(Window.partitionBy("conv_id", "block").orderBy("turn", "role", "said"))
    parts = (
        rows.withColumn("place", place)
        .withColumn("part", F.floor((F.col("place") - 1) / part_turns))
        .groupBy("conv_id", "block", "part")
        .agg(F.sort_array(F.collect_list(F.struct("place", "role", "said"))).alias("turns"))
    )
    speakers = rows.filter((F.col("role") != SYSTEM) & (F.col("role") != "")).select(
        F.col("conv_id").alias("of"), F.col("role").alias("speaker")
    )
    joined = parts.join(speakers.distinct(), F.col("conv_id").eqNullSafe(F.col("of")))

    def head(turn):
        return (
            F.when(turn["role"] == F.col("speaker"), "<|assistant|>\n")
            .when(turn["role"] == SYSTEM, "<|system|>\n")
            .otherwise(F.concat(F.lit("<|user|>"), F.when(turn["role"] != "", F.concat(F.lit(" name="), turn["role"])).otherwise(""), F.lit("\n")))
        )

    pieces = F.transform(
        "turns",
        lambda t: F.struct(
            (t["role"] == F.col("speaker")).alias("own"),
            head(t).alias("head"),
            F.concat(t["said"], F.lit(CLOSE)).alias("body"),
        ),
    )
    start = F.struct(F.lit(0).cast("bigint").alias("at"), F.array().cast("array<string>").alias("spans"))

    def marked(state, piece):
        begin = state["at"] + F.length(piece["head"])
        end = begin + F.length(piece["body"])
        span = F.concat(begin.cast("string"), F.lit("-"), end.cast("string"))
        spans = F.when(piece["own"], F.concat(state["spans"], F.array(span))).otherwise(state["spans"])
        return F.struct((end + 1).alias("at"), spans.alias("spans"))

    return joined.withColumn("pieces", pieces).select(
        "conv_id",
        "speaker",
        "block",
        "part",
        F.size("pieces").cast("bigint").alias("n_turns"),
        F.size(F.filter("pieces", lambda p: p["own"])).cast("bigint").alias("n_own"),
        F.array_join(F.transform("pieces", lambda p: F.concat(p["head"], p["body"], F.lit("\n"))), "").alias("text"),
        F.array_join(F.aggregate("pieces", start, marked, lambda s: s["spans"]), ",").alias("mask"),
    )
