"""Mixing sources to target weights by weighted fair queueing.

A source's documents are shuffled by a hash of their ids and queued in packets:
whole copies, but for the copy in service at virtual time 1, which is queued
in parts of ``PART`` words. A packet's virtual finish time is the source's
words up to and including it, over the source's target. All packets are sorted
by that time over all sources, their words are added up in that order, and the
schedule is cut where the budget, the sum of the targets, is spent. That is
where virtual time has just passed 1, so a source is off its target by less
than one packet.

Packets that begin at virtual time 1 or later can't be reached: until then
every source's packets that finish by 1 come first, and what they leave of the
budget is at most what the packets across 1 hold. They aren't queued.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tributary.llm.common import join_small, materialise, n_words, ordered_prefix

WEIGHTS = (1, 2, 3)
MAX_EPOCHS = 3
#: Words in a packet of the copy in service at the cut.
PART = 64


def targets(sizes: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """(source, size) rows to one row per source: source_rank, source_size, target.

    Sources in code-point order, null last, take the weights in turn and share
    the sum of all sizes; a target stops at ``max_epochs`` times its source's
    size, and the excess goes to the others by weight until none is above.
    That is a water level: sources are capped in the order of cap over weight,
    so prefix sums over the (few) sources give the level without iterating.
    """
    whole = Window.partitionBy()
    by_cap = whole.orderBy(F.col("cap") / F.col("weight"), "source_rank")
    exact = lambda c: F.col(c).cast("decimal(38,0)")
    src = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    src = src.withColumn("source_rank", F.row_number().over(whole.orderBy(F.col("source").asc_nulls_last())))
    src = src.withColumn("weight", F.element_at(F.array(*[F.lit(int(w)) for w in weights]), (F.col("source_rank") - 1) % len(weights) + 1).cast("long"))
    src = src.withColumn("cap", F.col("source_size") * max_epochs).withColumn("total", F.sum("source_size").over(whole))
    src = src.withColumn("left", F.col("total") - F.coalesce(F.sum("cap").over(by_cap.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)))
    src = src.withColumn("weights", F.sum("weight").over(by_cap.rowsBetween(0, Window.unboundedFollowing)))
    src = src.withColumn("capped", exact("left") * exact("weight") >= exact("cap") * exact("weights"))
    open_ = lambda c: F.sum(F.when(~F.col("capped"), F.col(c))).over(whole)
    src = src.withColumn("free", F.col("total") - F.coalesce(F.sum(F.when(F.col("capped"), F.col("cap"))).over(whole), F.lit(0))).withColumn("open", open_("weight"))
    share = (F.col("weight") * F.col("free")).cast("double") / F.col("open").cast("double")
    return src.select("source", "source_rank", "source_size", F.when(F.col("capped"), F.col("cap").cast("double")).otherwise(share).alias("target"))


def schedule(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS, whole_documents: bool = False) -> DataFrame:
    """The packets of rows (at, doc_id, source, size) that the mix takes words of: at, epoch, first, words, virtual_finish, place.

    ``first`` is a packet's first word in its document, ``place`` how many words
    the schedule has before it. The packet that the budget ends in gives its
    first words; with ``whole_documents`` copies are never cut into parts, and
    the one at the end is taken whole if its middle is within the budget.
    """
    rows = docs.select("at", "doc_id", "source", "size")
    src = materialise(targets(rows.select("source", "size"), weights, max_epochs).withColumnRenamed("source", "mix_source"), "targets")
    key = F.substring(F.md5(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), 1, 16)
    queued = join_small(rows.withColumn("mix_key", key), src, F.col("source").eqNullSafe(F.col("mix_source"))).filter("size > 0")
    queued = ordered_prefix(queued.select("at", "doc_id", "size", "source_rank", "source_size", "target", "mix_key"), ["mix_key", "doc_id", "size"], "size", "source_before", "source_rank")
    whole = lambda c: F.lit(c).cast("long")
    copies = queued.select("*", F.explode(F.sequence(whole(0), whole(max_epochs - 1))).alias("epoch"))
    start = F.col("epoch") * F.col("source_size") + F.col("source_before")
    copies = copies.withColumn("start", start).filter(F.col("start") < F.col("target"))
    if not whole_documents:
        parts = F.when(F.col("start") + F.col("size") > F.col("target"), F.sequence(whole(0), F.col("size") - 1, whole(PART))).otherwise(F.array(whole(0)))
        length = F.when(F.col("start") + F.col("size") > F.col("target"), F.least(whole(PART), F.col("size") - F.col("first"))).otherwise(F.col("size"))
        copies = copies.select("*", F.explode(parts).alias("first")).withColumn("length", length)
    else:
        copies = copies.withColumn("first", whole(0)).withColumn("length", F.col("size"))
    finish = (F.col("start") + F.col("first") + F.col("length")).cast("double") / F.col("target")
    packets = copies.select("at", "doc_id", "mix_key", "size", "source_rank", "epoch", "first", "length", finish.alias("virtual_finish"))
    sent = ordered_prefix(packets, ["virtual_finish", "source_rank", "epoch", "mix_key", "doc_id", "size", "first"], "length", "place")
    budget = F.lit(src.agg(F.coalesce(F.sum("source_size"), F.lit(0))).first()[0]).cast("long")
    if whole_documents:
        words = F.when(F.col("place") + F.col("length") / 2 <= budget, F.col("length")).otherwise(0)
    else:
        words = F.least(F.col("length"), budget - F.col("place"))
    return sent.withColumn("words", words.cast("long")).filter("words > 0").select("at", "epoch", "first", "words", "virtual_finish", "place")


def mix(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """Rows (doc_id, text, source) with what the mix takes of each: doc_id, source, size, source_size, target, taken.

    ``taken`` are the words of all packets that the schedule has of a document,
    repeats counted; the text itself is not shuffled. Null texts have no words;
    documents without words take nothing and are returned; null sources are one
    source, the last; equal rows are separate documents; an empty table gives
    no rows; columns besides those read are left out, so none can clash.
    """
    sized = docs.select("doc_id", "source", n_words("text").alias("size")).withColumn("at", F.monotonically_increasing_id())
    sized = materialise(sized, "sizes")
    taken = schedule(sized, weights, max_epochs).groupBy("at").agg(F.sum("words").alias("words"))
    goal = targets(sized.select("source", "size"), weights, max_epochs).select(F.col("source").alias("mix_source"), "source_size", "target")
    placed = join_small(sized, goal, F.col("source").eqNullSafe(F.col("mix_source")))
    joined = placed.join(taken, "at", "left")
    return joined.select("doc_id", "source", "size", "source_size", "target", F.coalesce("words", F.lit(0)).cast("long").alias("taken"))


def mixed_documents(docs: DataFrame, weights: Sequence[int] = WEIGHTS, max_epochs: int = MAX_EPOCHS) -> DataFrame:
    """The documents (doc_id, text, source, ...) that the mix takes, whole, once for each pass that it takes them in, in schedule order.

    All columns are kept, whatever their names. Documents without words are
    left out; nulls and equal rows are as in mix(). Only ids and sizes go
    through the schedule; the texts meet it once, at its end.
    """
    rows = docs.select(F.struct("*").alias("row")).withColumn("at", F.monotonically_increasing_id())
    rows = materialise(rows, "documents")
    sized = rows.select("at", F.col("row.doc_id").alias("doc_id"), F.col("row.source").alias("source"), n_words("row.text").alias("size"))
    sent = materialise(schedule(materialise(sized, "sizes"), weights, max_epochs, whole_documents=True).select("at", "place"), "schedule")
    return join_small(rows, sent, "at").orderBy("place").select("row.*")
