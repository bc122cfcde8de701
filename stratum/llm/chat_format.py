"""Multi-party perspective rotation of dialogues (DataFrame functions only).

For every participant of a conversation the dialogue is rendered once with
that speaker as the assistant, all others as named users, and a mask that
covers the assistant's own words. One line per turn:

    <|system|>\\ntext<|end|>\\n           roles in ``system_roles``, not participants
    <|assistant|>\\ntext<|end|>\\n        turns of the rotated speaker
    <|user name=NAME|>\\ntext<|end|>\\n   everybody else

The mask holds [start, end) code points of ``text<|end|>`` of the assistant's
turns, within the rendered string. In texts and names, whatever could be read as a
marker's edge gets one backslash more (``<|`` is ``<\\|``, ``|>`` is ``|\\>``), so no text
can forge a turn, and ``unescape`` gives the words back.

A view is the whole dialogue, whatever its length. Turns are put in order once per
conversation; a view's mask follows from running lengths and the speaker's number of
turns so far, so the work on a view is linear in it. A conversation and its views are
rows, so they have to fit in a task. Where a corrupt conversation doesn't, ``max_rows``
(off unless it is given) cuts every conversation, by position in order, into pieces of at
most that many rows; each piece is rendered like a dialogue of its own.

Defined cases: a null text is empty; a null role is the participant named
``unknown``; a null turn sorts first; equal turns are ordered by role and text; a null
conv_id is a conversation; a conversation with system turns alone has no
participant and gives no row; repeated rows are repeated turns.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.window import Window

from stratum.operators.ordering import numbered_rows, placed

END = "<|end|>"


def escape(col: Column) -> Column:
    once = F.regexp_replace(col, r"<(\\*)\|", r"<\\$1|")
    return F.regexp_replace(once, r"\|(\\*)>", r"|\\$1>")


def unescape(col: Column) -> Column:
    once = F.regexp_replace(col, r"\|\\(\\*)>", "|$1>")
    return F.regexp_replace(once, r"<\\(\\*)\|", "<$1|")


def _pieces(base: DataFrame, max_rows: int | None) -> DataFrame:
    """``base`` with ``piece``: the position in the conversation, divided by ``max_rows``; 0 without it."""
    if max_rows is None:
        return base.withColumn("piece", F.lit(0).cast("long"))
    order = [F.col("conv").asc_nulls_first(), F.col("turn").asc_nulls_first(), "speaker", "body", "_row"]
    at = placed(numbered_rows(base, "chat-rows"), order, "chat-placed").drop("_row")
    starts = at.groupBy(F.col("conv").alias("c")).agg(F.min("_at").alias("start"))
    return (at.join(starts, F.col("conv").eqNullSafe(F.col("c")))
              .withColumn("piece", F.floor((F.col("_at") - F.col("start")) / max_rows).cast("long")).drop("_at", "c", "start"))


def rotate_perspectives(turns: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn",
                        role_col: str = "role", text_col: str = "text",
                        system_roles: tuple[str, ...] = ("system",), max_rows: int | None = None) -> DataFrame:
    """(conv, piece, participant, n_turns, n_own, rendered, mask)."""
    base = turns.select(F.col(conv_col).alias("conv"), F.col(turn_col).alias("turn"),
                        F.coalesce(F.col(role_col), F.lit("unknown")).alias("speaker"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("body"))
    system = F.col("speaker").isin(*system_roles)
    people = base.where(~system).select(F.col("conv").alias("c"), F.col("speaker").alias("participant")).distinct()
    named = F.concat(F.lit("<|user name="), escape(F.col("speaker")), F.lit("|>\n"))
    lines = (_pieces(base, max_rows)
             .withColumn("head", F.when(system, F.lit("<|system|>\n")).otherwise(named))
             .withColumn("rest", F.concat(escape(F.col("body")), F.lit(END))))
    own_head = "<|assistant|>\n"
    in_order = Window.partitionBy("conv", "piece").orderBy(F.col("turn").asc_nulls_first(), "speaker", "body")
    before = in_order.rowsBetween(Window.unboundedPreceding, -1)
    mine_before = (Window.partitionBy("conv", "piece", "speaker").orderBy("place").rowsBetween(Window.unboundedPreceding, -1))
    # length of what precedes a turn if all speakers are users, and by how much the speaker's own turns before it are shorter
    lines = (lines.withColumn("place", F.row_number().over(in_order))
                  .withColumn("ahead", F.coalesce(F.sum(F.char_length("head") + F.char_length("rest") + 1).over(before), F.lit(0)))
                  .withColumn("saved", F.coalesce(F.sum(F.char_length("head") - len(own_head)).over(mine_before), F.lit(0))))
    start = F.col("ahead") - F.col("saved") + len(own_head)
    spans = (lines.where(~F.col("speaker").isin(*system_roles))
                  .withColumn("span", F.struct(start.cast("long").alias("start"), (start + F.char_length("rest")).cast("long").alias("end")))
                  .groupBy(F.col("conv").alias("mc"), F.col("piece").alias("mp"), F.col("speaker").alias("ms"))
                  .agg(F.sort_array(F.collect_list("span")).alias("mask")))
    whole = (lines.groupBy("conv", "piece")
                  .agg(F.sort_array(F.collect_list(F.struct("place", "speaker", "head", "rest"))).alias("rows")))
    views = whole.join(people, F.col("conv").eqNullSafe(F.col("c")))
    own = lambda r: (r["speaker"] == F.col("participant")) & ~r["speaker"].isin(*system_roles)
    rendered = F.array_join(F.transform("rows", lambda r: F.concat(
        F.when(own(r), F.lit(own_head)).otherwise(r["head"]), r["rest"], F.lit("\n"))), "")
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    same = (F.col("conv").eqNullSafe(F.col("mc")) & (F.col("piece") == F.col("mp")) & (F.col("participant") == F.col("ms")))
    return (views.withColumn("rendered", rendered).withColumn("n_turns", F.size("rows").cast("long")).drop("rows", "c")
                 .join(spans, same, "left").withColumn("mask", F.coalesce("mask", none))
                 .select("conv", "piece", "participant", "n_turns", F.size("mask").cast("long").alias("n_own"), "rendered", "mask"))
