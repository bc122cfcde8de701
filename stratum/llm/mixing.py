"""Mixing sources to target weights by weighted fair queueing.

Every source gets a share of a total budget by weight, but at most ``epochs``
times its own size; what is cut off goes to the others by weight, until no
source is above its cap. The documents of a source are shuffled by a hash of their
content. A document's copy gets a virtual finish time, the source's words up to its
end divided by the source's target (a second copy counts from one source size
on), so that all sources would end together at time 1. The mix is the copies in
the order of finish time, truncated at the total budget: whole documents, up to the
first one that would pass it.

Scale: only (id, source, size, hashes) is ordered, never a text. Running sums over a
source and over the mix come from range partitions and their offsets
(``order.placed``), in which a hot source or a hot repeated row is many
partitions like any other stretch. The water level of the targets is found by
rounds of one aggregate; the driver sees three numbers a round, and one cut.
No document moves because a run has other partitions: the order is total but for rows
equal in id, source and text, which are interchangeable.

Defined cases: a null or blank text has size 0 and is never taken; a null source
is a source, the last in order; repeated rows are documents of their own; a source
without words has target 0; an empty table gives no rows. A source falls short of its
target, or passes it, by less than a document of it or of the largest one.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

from stratum.operators.ordering import numbered_rows, placed, written
from stratum.llm.text import words

CYCLE = (3, 1, 2)


def source_targets(sizes: DataFrame, budget: float, weights: tuple[int, ...] = CYCLE, epochs: int = 2) -> DataFrame:
    """``sizes`` (source, source_size) with ``place`` (in code point order, null last) and ``target``."""
    at = placed(sizes, [F.col("source").isNull(), F.col("source")], "mix-sources", "place")
    weight = F.get(F.array(*[F.lit(w) for w in weights]), (F.col("place") % len(weights)).cast("int")).cast("double")
    at = written(at.withColumn("w", weight).withColumn("cap", (F.col("source_size") * epochs).cast("double")), "mix-weights")
    level, full = 0.0, -1
    while True:
        over = F.col("cap") < F.col("w") * level
        got = at.agg(F.coalesce(F.sum(F.when(over, F.col("cap"))), F.lit(0.0)).alias("caps"),
                     F.sum(F.when(~over, F.col("w"))).alias("w"), F.count_if(over).alias("full")).first()
        if got["full"] == full or not got["w"]:
            break
        level, full = (budget - got["caps"]) / got["w"], got["full"]
    return at.withColumn("target", F.least("cap", F.col("w") * level)).drop("w", "cap")


def _digest(id_col: str, text_col: str) -> Column:
    """Shuffles documents, and stands for (id, text)."""
    return F.md5(F.concat(F.coalesce(F.col(id_col).cast("string"), F.lit(" ")), F.lit(":"), F.coalesce(F.col(text_col), F.lit(""))))


def mix_plan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
             weights: tuple[int, ...] = CYCLE, budget_pct: int = 150, epochs: int = 2) -> DataFrame:
    """(id, source, size, source_size, target, taken, finish, h) per row of ``docs``: the words that the mix takes
    of it, the finish time of its first copy, and the digest of id and text that shuffles it."""
    rows = numbered_rows(docs.select(
        F.col(id_col).alias("id"), F.col(source_col).alias("source"), F.size(words(F.col(text_col))).cast("long").alias("size"),
        _digest(id_col, text_col).alias("h")), "mix-rows")
    sizes = written(rows.groupBy("source").agg(F.sum("size").alias("source_size")), "mix-sizes")
    budget = (sizes.agg(F.sum("source_size")).first()[0] or 0) * budget_pct / 100
    targets = written(source_targets(sizes, budget, weights, epochs), "mix-targets").withColumnRenamed("source", "s")
    # words of the source up to the end of each document, in shuffled order
    shuffled = placed(rows, [F.col("source").isNull(), F.col("source"), "h", "_row"], "mix-shuffled", running="size")
    first = shuffled.groupBy(F.col("source").alias("fs")).agg(F.min(F.col("_run") - F.col("size")).alias("start"))
    known = targets.join(first, F.col("s").eqNullSafe(F.col("fs"))).drop("fs")
    queue = written(shuffled.join(known, F.col("source").eqNullSafe(F.col("s"))).withColumn("upto", F.col("_run") - F.col("start"))
                            .drop("s", "_run", "start", "_at", "_row"), "mix-queue")

    def turn(epoch):
        return F.struct(((F.col("source_size") * epoch + F.col("upto")) / F.col("target")).alias("finish"), F.col("place"),
                        epoch.cast("int").alias("epoch"), F.col("upto"))

    copies = (queue.where("size > 0").select("size", F.explode(F.array(*[turn(F.lit(e)) for e in range(epochs)])).alias("t"))
                   .select("t.*", "size"))
    mixed = placed(copies, ["finish", "place", "epoch", "upto"], "mix-copies", running="size")
    cut = mixed.where(F.col("_run") <= budget).agg(F.max(F.struct("finish", "place", "epoch", "upto")).alias("cut")).first()["cut"]
    if cut is None:
        taken = F.lit(0).cast("long")
    else:
        last = F.struct(F.lit(cut["finish"]).alias("finish"), F.lit(cut["place"]).cast("long").alias("place"),
                        F.lit(cut["epoch"]).cast("int").alias("epoch"), F.lit(cut["upto"]).cast("long").alias("upto"))
        each = sum((F.when(turn(F.lit(e)) <= last, 1).otherwise(0) for e in range(epochs)), F.lit(0))
        taken = F.when(F.col("size") > 0, F.col("size") * each).otherwise(0)
    finish = F.when(F.col("size") > 0, F.col("upto") / F.col("target"))
    return queue.select("id", "source", "size", "source_size", "target", taken.cast("long").alias("taken"),
                        finish.alias("finish"), "h")


def mixed_sequence(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source", **plan) -> DataFrame:
    """The mix: (id, source, text, epoch, finish), one row per taken copy, range-partitioned and sorted by finish time."""
    rows = mix_plan(docs, id_col, text_col, source_col, **plan).where("taken > 0")
    copies = rows.select("id", "source", "h", F.explode(F.sequence(F.lit(0), (F.col("taken") / F.col("size")).cast("int") - 1)).alias("epoch"),
                         "finish", "source_size", "target")
    copies = copies.withColumn("finish", F.col("finish") + F.col("epoch") * F.col("source_size") / F.col("target"))
    texts = (docs.select(_digest(id_col, text_col).alias("th"), F.col(text_col).alias("text"))
                 .groupBy("th").agg(F.first("text").alias("text")))
    return (copies.join(texts, F.col("h") == F.col("th"))
                  .select("id", "source", "text", "epoch", "finish")
                  .repartitionByRange("finish", "source").sortWithinPartitions("finish", "source", "epoch", "id"))
