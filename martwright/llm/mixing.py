"""Mixing sources to target weights by Pfair scheduling.

Each source's documents, in hash order, are cut into blocks of ``block_bytes``. A source of weight
e/H owns e of every H slots: its block k (from 0) is released at slot floor(k H / e) and due before
slot ceil((k + 1) H / e). Earliest deadline first over these windows fills every slot and meets
every deadline, so after any number of slots each source is less than one block away from its
weight. The schedule repeats after H slots; only one period is computed, from the weights alone, and
a block's slot follows by arithmetic, whatever the size of the corpus. A source that has run out
leaves its slots empty; the others go on in proportion.

Defined results: every row is kept; null sources are one source; null and empty texts have no bytes
and stand where they fall in the order; repeated rows follow each other; an empty table stays empty.
A document longer than a block takes the slots of the blocks that it covers.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from martwright.operators.workspace import cut_lineage

SHARE_SLOTS = 1000


def source_weights(totals: DataFrame, power: float = 0.5, slots: int = SHARE_SLOTS) -> DataFrame:
    """Slots per period from each source's bytes raised to ``power``; every source gets one at least."""
    share = F.pow(F.col("bytes").cast("double"), F.lit(power))
    everything = Window.partitionBy(F.lit(0))
    return totals.select(
        "_source",
        F.greatest(
            F.lit(1), F.round(slots * share / F.greatest(F.sum(share).over(everything), F.lit(1.0)))
        )
        .cast("int")
        .alias("e"),
    )


def period(weights: DataFrame) -> DataFrame:
    """One period of the schedule: rows (_source, e, h, k, release, deadline, turn).

    ``weights`` has one row per source; its e slots add up to the period's length h.
    """
    gathered = weights.groupBy().agg(
        F.sort_array(F.collect_list(F.struct("_source", "e"))).alias("s"),
        F.sum("e").cast("int").alias("h"),
    )
    # acc.done: blocks each source has had; the choice is the released block of the earliest deadline.
    ready = (
        "filter(transform(s, (x, j) -> struct("
        "  (((acc.done[j] + 1) * h + x.e - 1) DIV x.e) AS deadline, j AS j,"
        "  acc.done[j] < x.e AND ((acc.done[j] * h) DIV x.e) <= t AS free)), y -> y.free)"
    )
    picks = F.expr(
        "aggregate(sequence(0, h - 1),"
        " struct(transform(s, x -> 0L) AS done, cast(array() AS array<int>) AS picks),"
        f" (acc, t) -> transform(array(array_min({ready}).j), p -> struct("
        "   transform(acc.done, (d, j) -> d + if(j = p, 1L, 0L)) AS done,"
        "   concat(acc.picks, array(p)) AS picks))[0],"
        " acc -> acc.picks)"
    )
    turns = gathered.where("h > 0").select("s", "h", F.posexplode(picks).alias("turn", "p"))
    of = Window.partitionBy("_source").orderBy("turn")
    return (
        turns.select(F.expr("s[p]._source").alias("_source"), F.expr("s[p].e").alias("e"), "h", "turn")
        .withColumn("k", F.row_number().over(of) - 1)
        .withColumn("release", F.expr("(k * h) DIV e"))
        .withColumn("deadline", F.expr("((k + 1) * h + e - 1) DIV e"))
    )


def mix(
    docs: DataFrame,
    key: str = "doc_id",
    source: str = "source",
    size: Column | None = None,
    weights: dict[str, float] | None = None,
    block_bytes: int = 65536,
    power: float = 0.5,
    seed: str = "mix",
) -> DataFrame:
    """``docs`` with block, release, deadline, slot and place; (slot, place) is the mixed order.

    ``size`` is a column of whole numbers (default: the bytes of ``text``). ``weights`` names target
    weights per source, and sources that it leaves out share the smallest of them; without it a
    source weighs its bytes to ``power``. ``place`` is the document's start inside its block.
    """
    size = F.octet_length(F.coalesce("text", F.lit(""))) if size is None else size
    sized = (
        docs.withColumn("_source", F.coalesce(F.concat(F.lit("="), F.col(source)), F.lit("")))
        .withColumn("_size", F.coalesce(size.cast("long"), F.lit(0)))
        .withColumn("_order", F.md5(F.concat_ws(":", F.lit(seed), F.col(key).cast("string")).cast("binary")))
    )
    # A source is summed up in ranges of its hash order, so that no task meets a whole source.
    totals = cut_lineage(
        sized.groupBy("_source").agg(F.sum("_size").alias("bytes"), F.count("*").alias("rows"))
    )
    rows = totals.agg(F.sum("rows")).first()[0] or 0
    bits = min(24, max(6, math.ceil(math.log2(max(1, rows) / 2000)) if rows else 6))
    part = F.shiftright(F.conv(F.substring("_order", 1, 6), 16, 10).cast("long"), 24 - bits)
    sized = sized.withColumn("_part", part)
    before = Window.partitionBy("_source").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = (
        sized.groupBy("_source", "_part")
        .agg(F.sum("_size").alias("_bytes"))
        .select("_source", "_part", F.coalesce(F.sum("_bytes").over(before), F.lit(0)).alias("_start"))
    )
    if weights is None:
        shares = source_weights(totals, power)
    else:
        named = {f"={name}": float(w) for name, w in weights.items()}
        least = min(named.values(), default=1.0)
        given = F.lit(least)
        for name, w in named.items():
            given = F.when(F.col("_source") == name, F.lit(w)).otherwise(given)
        whole = Window.partitionBy(F.lit(0))
        share = F.round(SHARE_SLOTS * given / F.sum(given).over(whole))
        shares = totals.select("_source", F.greatest(F.lit(1), share).cast("int").alias("e"))
    plan = cut_lineage(period(shares).coalesce(1))
    inside = Window.partitionBy("_source", "_part").orderBy("_order", "_size")
    placed = (
        sized.withColumn(
            "_run", F.coalesce(F.sum("_size").over(inside.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
        )
        .join(starts, ["_source", "_part"])
        .withColumn("_at", F.col("_start") + F.col("_run"))
        .withColumn("block", F.expr(f"_at DIV {block_bytes}"))
        .withColumn("place", F.col("_at") % block_bytes)
    )
    share = plan.select("_source", F.col("e").alias("_e"), F.col("h").alias("_h")).distinct()
    turns = plan.select("_source", *[F.col(c).alias(f"_{c}") for c in ("k", "turn", "release", "deadline")])
    return (
        placed.join(share, "_source")
        .withColumn("_k", F.expr("cast(block % _e AS int)"))
        .join(turns, ["_source", "_k"])
        .withColumn("_base", F.expr("(block DIV _e) * _h"))
        .withColumn("release", F.col("_base") + F.col("_release"))
        .withColumn("deadline", F.col("_base") + F.col("_deadline"))
        .withColumn("slot", F.col("_base") + F.col("_turn"))
        .drop(*(f"_{c}" for c in "source size order part run start at e h k turn release deadline base".split()))
    )
