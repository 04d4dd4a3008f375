"""Chat formatting by perspective rotation.

A dialogue of several parties is rendered once for every participant, who
then speaks as the assistant; the others are users with a name, system turns
stay system turns. The result has a row for every turn and perspective: the
rendered segment, its place in the rendered dialogue, and the part of it that
is trained on (what the assistant says, with the end mark). The segments of a
(conversation, perspective) in order of ``seq`` are the dialogue; nobody has
to hold a whole conversation to build it.

DataFrame functions only. Places are running sums along a conversation; long
conversations are split into ranges of turns (``running_totals``), and turns
meet the participants of a hot conversation in salted joins.

Defined results: participants are the distinct roles of a conversation but
null and ``system``; turns are in order of turn number (null last), role and
text (null first); a null role is a user without a name; a null text is
empty; rows with a null conversation are one conversation; a conversation
without participants has no rows; repeated turns stay; an empty table gives
an empty result; other columns are not needed. Marks of the template inside a
text are broken up by a space.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from leakwatch.operators.cumulative import running_totals
from leakwatch.operators.skew import salted_join

# Marks of the chat template.
OPEN, CLOSE, SYSTEM = "<|im_start|>", "<|im_end|>\n", "system"
#: A conversation with more turns is salted; ranges have so many rows.
HOT_TURNS = 10_000
ROWS_PER_RANGE = 250_000


def rotate(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role", text_col: str = "text") -> DataFrame:
    """(conv_id, perspective, seq, turn, role, name, content, start, stop,
    mask_start, mask_stop); the mask is null but for assistant segments."""
    speaker = F.col(role_col).cast("string")
    rows = turns.select(
        F.coalesce(F.concat(F.lit("="), F.col(conv_col).cast("string")), F.lit("")).alias("k"),
        F.col(conv_col).alias("conv_id"),
        F.col(turn_col).alias("turn"),
        speaker.alias("speaker"),
        F.replace(F.coalesce(F.col(text_col).cast("string"), F.lit("")), F.lit("<|"), F.lit("< |")).alias("said"),
        F.struct(F.col(turn_col).isNull().alias("late"), F.col(turn_col).alias("turn"), speaker.alias("speaker"), F.col(text_col).cast("string").alias("text")).alias("place"),
    )
    known = F.when(F.col("speaker") != SYSTEM, F.col("speaker"))
    parties = rows.groupBy("k").agg(F.array_sort(F.collect_set(known)).alias("parties"), F.count("*").alias("n")).checkpoint()
    met = salted_join(rows, parties.select("k", "parties"), ["k"], parties.where(F.col("n") > HOT_TURNS), "inner")
    views = met.select("*", F.explode("parties").alias("perspective")).drop("parties")

    role = F.when(F.col("speaker") == F.col("perspective"), "assistant").when(F.col("speaker") == SYSTEM, SYSTEM).otherwise("user")
    name = F.when(role == "user", F.replace("speaker", F.lit("<|"), F.lit("< |")))
    head = F.concat(F.lit(OPEN), role, F.coalesce(F.concat(F.lit(" name="), name), F.lit("")), F.lit("\n"))
    views = views.withColumns({"role": role, "name": name, "head": F.length(head).cast("long"), "content": F.concat(head, F.col("said"), F.lit(CLOSE))})
    views = views.drop("said", "speaker").withColumns({"size": F.length("content").cast("long"), "one": F.lit(1).cast("long")})
    summed = running_totals(views, ["k", "perspective"], "place", ["size", "one"], descending=False, rows_per_range=ROWS_PER_RANGE)
    start, stop = F.col("cum_size") - F.col("size"), F.col("cum_size")
    trained = F.col("role") == "assistant"
    return summed.select(
        "conv_id",
        "perspective",
        (F.col("cum_one") - 1).alias("seq"),
        "turn",
        "role",
        "name",
        "content",
        start.alias("start"),
        stop.alias("stop"),
        F.when(trained, start + F.col("head")).alias("mask_start"),
        F.when(trained, stop).alias("mask_stop"),
    )
