"""Sharding to near-equal bytes by histogram sort."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from netpulse.llm.common import long_array, position_in, stored

#: Probes set inside an interval that is still too coarse.
FAN_OUT = 64
#: A splitter is settled when its interval holds at most this share of a shard's bytes.
TOLERANCE = 0.001
#: A group of equal texts up to this share of a shard stays in one shard.
GROUP_SHARE = 0.05
#: Intervals above this share of the rows are refined too, so that none is one task's burden.
ROW_SHARE = 1 / 1000
#: Low bits of a place that order documents of one text; the rest is the hash of the text.
COPY_BITS = 24
#: Repeats of one row that are written out at a time.
REPEATS = 4096
_LOW, _HIGH = -(2**63), 2**63 - 1


def placed(docs: DataFrame) -> DataFrame:
    """doc_id, size, text_crc32 and place, a bigint that orders rows with equal texts side by side.

    Rows equal in id and text are counted and written out again under a number each, so that they
    have places of their own however many there are; a null id is an id.
    """
    size = F.coalesce(F.octet_length("text"), F.lit(0)).cast("bigint") + 16
    group = F.shiftleft(F.shiftright(F.xxhash64("text"), COPY_BITS), COPY_BITS)
    crc = F.coalesce(F.crc32(F.col("text").cast("binary")), F.lit(0)).cast("bigint")
    rows = docs.select("doc_id", size.alias("size"), crc.alias("text_crc32"), group.alias("group"))
    counted = rows.groupBy("doc_id", "size", "text_crc32", "group").agg(F.count("*").alias("n"))
    some = counted.withColumn("first", F.explode(F.sequence(F.lit(0).cast("bigint"), F.col("n") - 1, F.lit(REPEATS).cast("bigint"))))
    last = F.least(F.col("n"), F.col("first") + REPEATS) - 1
    each = some.withColumn("number", F.explode(F.sequence("first", last)))
    copy = F.xxhash64("doc_id", "number").bitwiseAND(F.lit((1 << COPY_BITS) - 1))
    return each.select("doc_id", "size", "text_crc32", F.col("group").bitwiseOR(copy).alias("place"))


def histogram(rows: DataFrame, probes: list[int]) -> dict[int, tuple[int, int]]:
    """Exact (bytes, rows) per interval; interval i holds the places from probe i - 1 up to below probe i."""
    found = rows.groupBy(position_in(probes, F.col("place")).alias("i")).agg(F.sum("size"), F.count("*")).collect()
    return {r[0]: (r[1], r[2]) for r in found}


def splitters(rows: DataFrame, shards: int) -> tuple[list[int], list[int], dict[int, tuple[int, int]]]:
    """Places at which shards begin, all probes, and the histogram over them.

    Each round counts exact bytes below all probes in one pass and sets more probes inside the
    intervals that a target falls into, until such an interval is narrow enough. The driver holds
    the probes and their counts, a number set by the shard count and not by the data. A splitter
    moves to the edge of a group of equal texts unless the group weighs more than GROUP_SHARE of a
    shard; larger groups are cut between documents.
    """
    width = (_HIGH - _LOW) // (shards * FAN_OUT)
    probes = [_LOW + width * i for i in range(1, shards * FAN_OUT)]
    while True:
        counts = histogram(rows, probes)
        total, number = (sum(c[k] for c in counts.values()) for k in (0, 1))
        ideal, below, coarse, chosen = total / shards, 0, set(), []
        targets = iter([ideal * s for s in range(1, shards)])
        target = next(targets, None)
        for i in range(len(probes) + 1):
            size, n = counts.get(i, (0, 0))
            low, high = probes[i - 1] if i else _LOW, probes[i] if i < len(probes) else _HIGH
            while target is not None and total and target <= below + size:
                if size > TOLERANCE * ideal and n > 1 and high - low > 1:
                    coarse.add((low, high))
                chosen.append(low if target - below < below + size - target else high)
                target = next(targets, None)
            if n > ROW_SHARE * number + 1 and high - low > 1:
                coarse.add((low, high))
            below += size
        if not coarse:
            break
        for low, high in coarse:
            step = max(1, (high - low) // FAN_OUT)
            probes.extend(range(low + step, high, step))
        probes = sorted(set(probes))
    chosen += [_HIGH] * (shards - 1 - len(chosen))
    chosen, probes, counts = _keep_groups(rows, chosen, probes, counts, ideal)
    return chosen, probes, counts


def _keep_groups(rows: DataFrame, chosen: list[int], probes: list[int], counts: dict, ideal: float):
    edges = {c: ((c >> COPY_BITS) << COPY_BITS, min(_HIGH, ((c >> COPY_BITS) + 1) << COPY_BITS)) for c in chosen}
    probes = sorted({*probes, *chosen, *(e for pair in edges.values() for e in pair)} - {_LOW})
    counts = histogram(rows, probes)
    below, run = {_LOW: 0}, 0
    for i, probe in enumerate(probes):
        run += counts.get(i, (0, 0))[0]
        below[probe] = run
    for k, c in enumerate(chosen):
        low, high = edges[c]
        if c != low and below[high] - below[low] <= GROUP_SHARE * ideal:
            chosen[k] = low if below[c] - below[low] <= below[high] - below[c] else high
    return sorted(chosen), probes, counts


def sharded(docs: DataFrame, shards: int = 40) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard for every row, under the law ``bytes``.

    Rows go to their shard in one exchange, by interval and not by shard, so that a shard may be
    larger than a task; slot is the row's number in the shard, 0 upwards, from exact counts before
    its interval. Equal texts lie side by side. A null text counts as empty, a null doc_id as one
    more id; repeated rows get slots of their own, and places of their own if more than a shard
    holds; empty tables give no rows; extra columns are ignored.
    """
    rows = stored(placed(docs), "placed")
    chosen, probes, counts = splitters(rows, shards)
    shard_of, offset_of, shard, filled = [], [], 0, 0
    for i in range(len(probes) + 1):
        low = probes[i - 1] if i else _LOW
        while shard < len(chosen) and chosen[shard] <= low:
            shard, filled = shard + 1, 0
        shard_of.append(shard)
        offset_of.append(filled)
        filled += counts.get(i, (0, 0))[1]
    order = Window.partitionBy("interval").orderBy("place", "text_crc32", "doc_id", "size")
    dealt = rows.withColumn("interval", position_in(probes, F.col("place")))
    return dealt.select(
        "doc_id", "size", "text_crc32", F.lit("bytes").alias("law"),
        F.get(long_array(shard_of), F.col("interval")).cast("int").alias("shard"),
        (F.get(long_array(offset_of), F.col("interval")) + F.row_number().over(order) - 1).alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"),
    )
