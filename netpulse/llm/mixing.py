"""Mixing sources to target weights by capped water-filling."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from netpulse.llm.common import stored, word_count

#: Seeded sampling slots of a source: a slot is taken or left as a whole.
SLOTS = 1024
#: Rounds in which slots fill what earlier, larger ones left open.
FILL_ROUNDS = 6


def cyclic_weight(rank: Column) -> Column:
    """1, 2, 3, repeating, over sources in code-point order."""
    return F.pmod(rank - 1, F.lit(3)) + 1


def mixing_plan(
    sized: DataFrame,
    weight: Callable[[Column], Column] = cyclic_weight,
    share: float = 1.0,
    max_epochs: int = 3,
) -> DataFrame:
    """How often each slot of each source enters the mix.

    ``sized`` has source, size and slot (see :func:`with_slots`), and is read three times: store it
    first. Returns one row per source and slot: source, slot, source_size, target, repeats.

    Targets share ``share`` of all sizes by weight. A source whose target passes ``max_epochs`` times
    its size is clamped there and its excess goes to the others by weight, until none is above. A
    source then repeats ``floor(target / size)`` times whole; the fraction is covered by slots taken
    in seeded order while they fit. Sources are a table like any other: ranked within range
    partitions, and only sums reach the driver. A null source is a source, the last one; sources
    without words get target 0; no rows give an empty plan.
    """
    sources = stored(_ranked(sized.groupBy("source").agg(F.sum("size").alias("source_size")), weight), "sources")
    cap = F.col("source_size") * F.lit(float(max_epochs))
    total = (sources.agg(F.sum("source_size")).first()[0] or 0) * share
    level, clamped = 0.0, -1
    while True:
        full = F.col("weight") * F.lit(level) >= cap
        state = sources.agg(
            F.count_if(full).alias("clamped"),
            F.sum(F.when(full, cap).otherwise(0.0)).alias("held"),
            F.sum(F.when(~full, F.col("weight").cast("double")).otherwise(0.0)).alias("open_weight"),
        ).first()
        if state.clamped == clamped or not state.open_weight:
            break
        clamped, level = state.clamped, (total - state.held) / state.open_weight

    target = F.least(cap, F.col("weight") * F.lit(level))
    whole = F.when(F.col("source_size") > 0, F.floor(target / F.col("source_size"))).otherwise(0)
    targets = sources.select("source", "source_size", target.alias("target"), whole.cast("bigint").alias("whole"))
    slots = sized.groupBy("source", "slot").agg(F.sum("size").alias("slot_size"))
    plan = slots.alias("s").join(targets.alias("t"), F.expr("s.source <=> t.source")).select("s.*", "source_size", "target", "whole")
    return stored(_fill(plan), "mix").select(
        "source", "slot", "source_size", "target", (F.col("whole") + F.col("extra").cast("bigint")).alias("repeats")
    )


def with_slots(docs: DataFrame, seed: int = 17) -> DataFrame:
    """Add size (words of text) and slot (seeded by doc_id alone)."""
    return docs.withColumns(
        {"size": word_count(F.col("text")), "slot": F.pmod(F.xxhash64(F.lit(seed), "doc_id"), F.lit(SLOTS)).cast("int")}
    )


def mixed_sizes(docs: DataFrame, **options) -> DataFrame:
    """doc_id, source, size, source_size, target, taken for every row; no text moves."""
    sized = stored(with_slots(docs.select("doc_id", "text", "source")).drop("text"), "sized")
    return _planned(sized, mixing_plan(sized, **options)).select(
        "doc_id", "source", "size", "source_size", "target", (F.col("size") * F.col("repeats")).alias("taken")
    )


def mixed(docs: DataFrame, **options) -> DataFrame:
    """The mix itself: every row of ``docs`` as often as the plan says, columns unchanged.

    Nulls: a null text has no words and follows its slot; a null doc_id has a slot of its own. Rows
    sharing a doc_id share a slot. Extra columns are kept, whatever their names.
    """
    names = docs.columns
    row = docs.select(F.struct(*[docs[n] for n in names]).alias("row"))
    keyed = row.select("row", F.col("row.doc_id").alias("doc_id"), F.col("row.text").alias("text"), F.col("row.source").alias("source"))
    plan = mixing_plan(stored(with_slots(keyed.select("doc_id", "text", "source")).drop("text"), "sized"), **options)
    taken = _planned(with_slots(keyed).drop("text"), plan).where("repeats > 0")
    return taken.select("row", F.explode(F.sequence(F.lit(1), F.col("repeats").cast("int")))).select("row.*")


def _planned(rows: DataFrame, plan: DataFrame) -> DataFrame:
    # slots spread a source that holds a large share of the rows over many join keys
    plan = plan.withColumnsRenamed({"source": "_source", "slot": "_slot"})
    return rows.join(plan, F.expr("source <=> _source AND slot = _slot"))


def _ranked(sources: DataFrame, weight: Callable[[Column], Column]) -> DataFrame:
    """Add the weight by rank in code-point order, null last, without gathering all sources in a task."""
    order = F.asc_nulls_last("source")
    ranged = stored(sources.repartitionByRange(order).withColumn("part", F.spark_partition_id()), "ranged")
    within = F.row_number().over(Window.partitionBy("part").orderBy(order))
    # one row per range partition
    sums = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    before = ranged.groupBy("part").count().select("part", F.coalesce(F.sum("count").over(sums), F.lit(0)).alias("before"))
    return ranged.withColumn("within", within).join(before, "part").select(
        "source", "source_size", weight(F.col("before") + F.col("within")).alias("weight")
    )


def _fill(plan: DataFrame) -> DataFrame:
    """Choose slots worth the fractional part of each target; at most SLOTS rows per source.

    A slot without words enters where something is left to fill, or where its source would not enter
    at all; so it is not repeated once more than a source at its cap.
    """
    source = Window.partitionBy("source")
    running = source.orderBy("slot").rowsBetween(Window.unboundedPreceding, 0)
    plan = plan.withColumns(
        {"open": F.col("target") - F.col("whole") * F.col("source_size"), "extra": F.lit(False)}
    )
    for _ in range(FILL_ROUNDS):
        worth = (F.col("slot_size") > 0) | (F.col("open") > 0) | (F.col("whole") == 0)
        fits = ~F.col("extra") & worth & (F.col("slot_size") <= F.col("open"))
        plan = plan.withColumn("reach", F.sum(F.when(fits, F.col("slot_size")).otherwise(0)).over(running))
        plan = plan.withColumn("now", fits & (F.col("reach") <= F.col("open")))
        plan = plan.withColumn("filled", F.sum(F.when(F.col("now"), F.col("slot_size")).otherwise(0)).over(source))
        plan = plan.withColumns(
            {"open": F.col("open") - F.col("filled"), "extra": F.col("extra") | F.col("now")}
        )
    # the last step may overshoot: the smallest slot left out enters if that comes nearer to the target
    left_out = F.when(~F.col("extra") & (F.col("slot_size") > 0), F.struct("slot_size", "slot"))
    plan = plan.withColumn("least", F.min(left_out).over(source))
    nearer = (F.col("slot") == F.col("least.slot")) & (F.col("slot_size") < 2 * F.col("open"))
    plan = plan.withColumn("extra", F.col("extra") | F.coalesce(nearer, F.lit(False)))
    return plan.drop("open", "reach", "now", "filled", "least")
