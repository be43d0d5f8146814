"""What several operators share: stored intermediate tables, row keys, bounded search, components."""

from __future__ import annotations

import json
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netpulse.session import fresh_folder

#: ASCII white space separates words; everything else belongs to one.
WORD = r"[^\x20\x09-\x0D]+"
#: Stands for a null doc_id in row keys and orders after every real id.
NO_ID = 2**63 - 1


def stored(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    The table cuts the lineage, survives lost executors and gives Spark the true size for the next
    join. It lies below ``spark.checkpoint.dir``.
    """
    path = fresh_folder(df.sparkSession, f"llm-{label}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """A few rows at a time, so that a worker holds Python objects and results of a slice only.

    Workers outlive their task; buffers that the last batch left behind go back at its end.
    """
    for batch in batches:
        for start in range(0, batch.num_rows, rows):
            yield batch.slice(start, rows)
        del batch
        pa.default_memory_pool().release_unused()


def word_count(text: Column) -> Column:
    """Number of words as bigint; 0 for null."""
    return F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint")


def with_row_key(docs: DataFrame) -> DataFrame:
    """Add ``_key_id`` and ``_key_text``, never null: rows equal in both are one document repeated."""
    return docs.withColumns(
        {"_key_id": F.coalesce(F.col("doc_id").cast("bigint"), F.lit(NO_ID)), "_key_text": F.xxhash64("text")}
    )


def long_array(values: Sequence[int]) -> Column:
    """A constant array of bigint; one literal however long it is."""
    return F.from_json(F.lit(json.dumps([int(v) for v in values])), "array<bigint>")


def position_in(bounds: Sequence[int], value: Column) -> Column:
    """How many of the ascending ``bounds`` are at most ``value`` (binary search, int)."""
    if not bounds:
        return F.lit(0)
    table, n = long_array(bounds), len(bounds)
    steps = F.array(*[F.lit(1 << bit) for bit in range(n.bit_length() - 1, -1, -1)])

    def forward(low: Column, step: Column) -> Column:
        probe = low + step
        return F.when((probe <= n) & (F.get(table, probe - 1) <= value), probe).otherwise(low)

    return F.aggregate(steps, F.lit(0), forward)


def connected_components(edges: DataFrame) -> DataFrame:
    """Smallest reachable node of every node that has an edge: ``(node, root)`` from ``(a, b)``, bigint.

    Alternates large-star and small-star steps until nothing changes (Kiveris et al., 2014); the
    number of rounds grows with the logarithm of the component size. Each step is two stored
    tables: the least neighbour of a node, and the rewired edges. The join between them reads both
    from storage, so Spark can split a node that a large component hangs on.
    """
    current = stored(
        edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges"
    )
    before = _state(current)
    while before[0]:
        current = _star(_star(current, large=True), large=False)
        after = _state(current)
        if after == before:
            break
        before = after
    roots = current.select(F.col("b").alias("node")).distinct().select("node", F.col("node").alias("root"))
    return current.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One step over edges a > b. Large: greater neighbours move to the least one; small: the others do."""
    if large:
        pairs = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    else:
        pairs = edges
    least = stored(
        pairs.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m")),
        "least",
    )
    moved = pairs.where("b > a") if large else edges
    rewired = moved.join(least, F.col("a") == F.col("n")).select(F.col("b").alias("a"), F.col("m").alias("b"))
    if not large:
        rewired = rewired.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b")))
    return stored(rewired.where("a <> b").distinct(), "star")


def _state(edges: DataFrame) -> tuple:
    found = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(found)
