"""Substring dedup by content-defined chunking with a gear rolling hash."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import slices, stored, with_row_key

#: Bytes that the rolling hash sees, and one cut in so many places where a word starts.
SPAN, CUT_ONE_IN = 16, 4
#: A chunk without such a place is cut after so many bytes.
LONGEST = 256
#: Repeated chunks in a row are removed from so many words or, where words are rare, bytes on.
LEAST_WORDS, LEAST_BYTES = 20, 600

_GEAR = np.frombuffer(np.random.Generator(np.random.PCG64(2024)).bytes(1024), "<u4")
_SPACE = np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])


def cut_points(data: bytes) -> np.ndarray:
    """Offsets at which chunks start, 0 first, then the end.

    The gear hash of a place sums a random number per byte, shifted by its distance, over the SPAN
    bytes before it, so it depends on them alone and cuts come back after an insertion. Cuts fall
    where a word starts, or after a character of three or more bytes.
    """
    n = len(data)
    if not n:
        return np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)
    sums = _GEAR[raw].copy()
    step = 1
    while step < SPAN:  # sums of twice as many bytes each round
        sums[step:] = sums[step:] + (sums[:-step] << np.uint32(step))
        step *= 2
    space, tail = _SPACE[raw], (raw & 0xC0) == 0x80
    wide = np.zeros(n, bool)
    wide[2:] = tail[2:] & tail[1:-1]
    place = np.zeros(n, bool)
    place[1:] = ((space[:-1] & ~space[1:]) | (wide[:-1] & ~tail[1:])) & (sums[:-1] >> np.uint32(16) < 65536 // CUT_ONE_IN)
    cuts = np.r_[0, np.flatnonzero(place), n]
    gaps = np.diff(cuts)
    if (gaps > LONGEST).any():
        more = []
        for start, gap in zip(cuts[:-1][gaps > LONGEST], gaps[gaps > LONGEST]):
            for at in range(start + LONGEST, start + gap, LONGEST):
                while at < start + gap and tail[at]:
                    at += 1
                more.append(at)
        cuts = np.unique(np.r_[cuts, np.array(more, np.int64)])
    return cuts


def _passage_ends(cuts: np.ndarray, begun: np.ndarray) -> np.ndarray:
    """For each chunk the place in ``cuts`` up to which chunks from it on are long enough; past the end if none is."""
    by_words = np.searchsorted(begun, begun[:-1] + LEAST_WORDS)
    return np.minimum(by_words, np.searchsorted(cuts, cuts[:-1] + LEAST_BYTES))


def _passage_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    digest = xxhash.xxh3_128_digest
    for batch in slices(batches):
        keys = [batch.column(i).to_numpy() for i in (0, 1)]
        held: list[list] = [[], [], [], []]
        rows = 0
        for i, data in enumerate(batch.column(2).to_pylist()):
            if not data:
                continue
            cuts = cut_points(data)
            raw = _SPACE[np.frombuffer(data, np.uint8)]
            begins = np.r_[0, np.cumsum(~raw & np.r_[True, raw[:-1]])]
            first = np.arange(len(cuts) - 1)
            end = _passage_ends(cuts, begins[cuts])
            first, end = first[end < len(cuts)], end[end < len(cuts)]
            if len(first) and end[-1] < len(cuts) - 1:  # the last passage also up to the end of the text
                first, end = np.r_[first, first[-1]], np.r_[end, len(cuts) - 1]
            a, b = cuts[first], cuts[end]
            made = b"".join(digest(data[x:y]) for x, y in zip(a.tolist(), b.tolist()))
            columns = (np.full(len(a), keys[0][i]), np.full(len(a), keys[1][i]), a << 32 | (b - a), made)
            for held_one, column in zip(held, columns):
                held_one.append(column)
            rows += len(a)
            if rows > 50_000:
                yield _passage_batch(held, rows)
                held, rows = [[], [], [], []], 0
        if rows:
            yield _passage_batch(held, rows)


def _passage_batch(held: list[list], rows: int) -> pa.RecordBatch:
    digests = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), rows, [None, pa.py_buffer(b"".join(held[-1]))])
    columns = [*(pa.array(np.concatenate(x)) for x in held[:-1]), digests.cast(pa.binary())]
    return pa.RecordBatch.from_arrays(columns, names=["_key_id", "_key_text", "span", "digest"])


def passages(docs: DataFrame) -> DataFrame:
    """_key_id, _key_text, span, digest: from every chunk on, the chunks that make LEAST_WORDS words or
    LEAST_BYTES bytes, and from the last such chunk on all that is left. A span is its start and, in the lower 32 bits, its size, both in UTF-8 bytes; digests
    have 128 bits."""
    source = with_row_key(docs.select("doc_id", "text")).select("_key_id", "_key_text", F.col("text").cast("binary"))
    return source.mapInArrow(_passage_batches, "_key_id bigint, _key_text bigint, span bigint, digest binary")


def repeated_passages(docs: DataFrame) -> DataFrame:
    """_key_id, _key_text, spans: per document its passages that a document before it has too, in order.

    The digest of a passage is counted where it arises, so one in a large share of the documents
    reaches the shuffle once per task. Only digests that several documents have are stored; the join
    reads them from there, and Spark splits a digest that many passages have.
    """
    made = passages(docs)
    seen = made.groupBy("digest").agg(F.min("_key_id").alias("first"), F.max("_key_id").alias("last"))
    shared = stored(seen.where(F.col("first") < F.col("last")).select(F.col("digest").alias("_digest"), "first"), "shared")
    later = made.join(shared, (F.col("digest") == F.col("_digest")) & (F.col("_key_id") > F.col("first")))
    return later.groupBy("_key_id", "_key_text").agg(F.sort_array(F.collect_set("span")).alias("spans"))


def _cut(text: bytes, spans: list[int]) -> tuple[bytes, int, int]:
    """Remove runs of adjoining or overlapping spans, which come in order: what is left, runs, bytes removed."""
    left, at, removed, runs, i = [], 0, 0, 0, 0
    while i < len(spans):
        begin = end = spans[i] >> 32
        while i < len(spans) and spans[i] >> 32 <= end:
            end, i = max(end, (spans[i] >> 32) + (spans[i] & 0xFFFFFFFF)), i + 1
        left.append(text[at:begin])
        removed, runs, at = removed + end - begin, runs + 1, end
    left.append(text[at:])
    return b"".join(left), runs, removed


def deduplicated(docs: DataFrame) -> DataFrame:
    """``docs`` with repeated passages cut out of ``text``, and ``_runs``, ``_removed`` (bytes).

    A passage stays in the document with the smallest doc_id that has it (null ids are greatest) and
    goes from all others. A passage is chunks that follow each other for LEAST_WORDS words or
    LEAST_BYTES bytes in one earlier document; shorter repeats and runs patched from several documents
    stay. Of a repeated passage, the ends up to the nearest cut may stay. Repeats inside one document
    and rows that share its doc_id stay. Null and empty texts stay as they are; a text that is repeated as a
    whole becomes empty, no row goes. Each text is shuffled once, to meet its spans.
    """
    names = docs.columns
    spans = repeated_passages(docs).withColumnsRenamed(
        {"_key_id": "_span_id", "_key_text": "_span_text", "spans": "_spans"}
    )
    keyed = with_row_key(docs).join(spans, F.expr("_key_id = _span_id AND _key_text = _span_text"), "left")
    kept = [n for n in names if n != "text"]
    source = keyed.select(
        F.col("text").alias("_in"), F.col("_spans"),
        *[F.col(n).alias(f"_c{i}") for i, n in enumerate(kept)],
    )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            texts, runs, removed = batch.column(0).to_pylist(), [], []
            lists = batch.column(1).to_pylist()
            for i, text in enumerate(texts):
                done = (0, 0)
                if text and lists[i]:
                    data, *done = _cut(text.encode(), lists[i])
                    texts[i] = data.decode() if done[0] else text
                runs.append(done[0])
                removed.append(done[1])
            yield pa.RecordBatch.from_arrays(
                [pa.array(texts, pa.string()), pa.array(runs, pa.int32()), pa.array(removed, pa.int64()), *batch.columns[2:]],
                names=["_text", "_runs", "_removed", *batch.schema.names[2:]],
            )

    fields = ["_text string", "_runs int", "_removed bigint", *[f"_c{i} {docs.schema[n].dataType.simpleString()}" for i, n in enumerate(kept)]]
    out = source.mapInArrow(run, ", ".join(fields))
    back = {n: f"_c{i}" for i, n in enumerate(kept)} | {"text": "_text"}
    return out.select(*[F.col(back[n]).alias(n) for n in names], "_runs", "_removed")
