"""SimHash near-dedup with covering locality-sensitive hashing."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from netpulse.llm.common import connected_components, slices, stored, with_row_key

#: Words in a shingle, and differing bits up to which fingerprints link.
SHINGLE, RADIUS = 3, 2
#: Buckets above this are split by further masks inside the bits they leave open.
SPLIT_ABOVE = 512
#: Rounds of splitting; the last leaves so few open bits that buckets are bounded by 2 ** bits.
LEVELS = 3
#: Buckets up to this size are compared pair by pair across a whole batch at once.
SMALL = 12

_BITS = ((np.arange(256)[:, None] >> np.arange(8)) & 1).astype(np.int64)


def covering_masks(positions: list[int], radius: int = RADIUS) -> list[int]:
    """Masks of the bits to keep, such that any ``radius`` positions are all left out by one of them.

    Position i gets a non-zero vector m(i) of radius + 1 bits; the mask of a non-zero v keeps the
    positions with odd <m(i), v>. For any ``radius`` vectors some v is orthogonal to all of them
    (Pagh, 2016), so a pair within the radius agrees on everything that mask keeps.
    """
    n = 2 ** (radius + 1)
    return [
        sum(1 << p for i, p in enumerate(positions) if ((i % (n - 1) + 1) & v).bit_count() % 2) for v in range(1, n)
    ]


def mask_tree(levels: int = LEVELS) -> list[dict[tuple[int, ...], int]]:
    """Masks by path and level: those of a level refine the open bits of the one above."""
    tree = [{(): 0}]
    for _ in range(levels):
        tree.append(
            {
                (*path, t): mask | sub
                for path, mask in tree[-1].items()
                for t, sub in enumerate(covering_masks([p for p in range(64) if not mask >> p & 1]))
            }
        )
    return tree[1:]


def shingle_hashes(text: bytes, width: int = SHINGLE) -> list[int]:
    """XXH64 (seed 42) of every run of ``width`` words, repeats included; fewer words count as one run."""
    words = text.lower().split()  # bytes: A-Z and ASCII white space only
    if not words:
        return []
    if len(words) < width:
        runs = [b" ".join(words)]
    else:
        runs = map(b" ".join, zip(*[words[i:] for i in range(width)]))
    digest = xxhash.xxh64_intdigest
    return [digest(run, 42) for run in runs]


def simhashes(texts: list[bytes | None]) -> np.ndarray:
    """uint64 per text: bit set where over half the shingle hashes have it; 0 without words."""
    out = np.zeros(len(texts), np.uint64)
    for i, text in enumerate(texts):
        hashes = shingle_hashes(text or b"")
        if not hashes:
            continue
        octets = np.array(hashes, "<u8").view(np.uint8).reshape(-1, 8)
        ones = np.concatenate([np.bincount(octets[:, j], minlength=256) @ _BITS for j in range(8)])
        out[i] = np.packbits(ones * 2 > len(hashes), bitorder="little").view("<u8")[0]
    return out


def _fingerprint_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in slices(batches):
        found = simhashes(batch.column("text").to_pylist()).view(np.int64)
        columns = [c for name, c in zip(batch.schema.names, batch.columns) if name != "text"]
        names = [name for name in batch.schema.names if name != "text"]
        yield pa.RecordBatch.from_arrays([*columns, pa.array(found)], names=[*names, "fp"])


def fingerprints(docs: DataFrame) -> DataFrame:
    """_key_id, _key_text and fp (bigint with the bits of the fingerprint) of every row, in one pass."""
    keyed = with_row_key(docs.select("doc_id", "text")).select(
        "_key_id", "_key_text", "doc_id", F.col("text").cast("binary").alias("text")
    )
    return keyed.mapInArrow(_fingerprint_batches, "_key_id bigint, _key_text bigint, doc_id bigint, fp bigint")


def link_edges(nodes: DataFrame) -> DataFrame:
    """Edges ``(a, b)`` that connect what links within the radius, from distinct ``fp``.

    Every fingerprint enters one bucket per mask. A bucket above SPLIT_ABOVE is replaced by its
    buckets under finer masks, which still cover the radius; at the last level few bits are open and
    a bucket cannot be large. A bucket yields a spanning forest, not its pairs.
    """
    tables, pending = [], nodes.select("fp", F.lit(0).alias("path"))
    for level, masks in enumerate(mask_tree()):
        keyed = _keyed(pending, masks, level)
        if level == LEVELS - 1:
            tables.append(keyed)
            break
        counts = keyed.groupBy("path", "key").agg(F.count("*").alias("n")).where(F.col("n") > SPLIT_ABOVE)
        hot = stored(counts.select("path", "key"), "hot")
        tables.append(keyed.join(hot, ["path", "key"], "left_anti"))
        if hot.isEmpty():
            break
        pending = stored(keyed.join(hot, ["path", "key"], "left_semi").select("fp", "path"), "split")
    rows = tables[0]
    for more in tables[1:]:
        rows = rows.unionByName(more)
    dealt = rows.repartition("path", "key").sortWithinPartitions("path", "key", "fp")
    return dealt.select("path", "key", "fp").mapInPandas(_bucket_edges, "a bigint, b bigint")


def _keyed(pending: DataFrame, masks: dict[tuple[int, ...], int], level: int) -> DataFrame:
    """One row per mask below the row's path; path numbers are base 8 digits with a leading 1."""
    by_parent: dict[int, list[tuple[int, int]]] = {}
    for path, mask in masks.items():
        by_parent.setdefault(_number(path[:-1]) if level else 0, []).append((_number(path), _signed(mask)))
    choice = F.lit(None)
    arrays = {
        parent: F.from_json(
            F.lit(str([{"path": p, "mask": m} for p, m in made]).replace("'", '"')), "array<struct<path:int,mask:bigint>>"
        )
        for parent, made in by_parent.items()
    }
    if len(arrays) == 1:
        choice = next(iter(arrays.values()))
    else:
        entries = [x for parent, made in arrays.items() for x in (F.lit(parent), made)]
        choice = F.get(F.map_values(F.map_filter(F.create_map(*entries), lambda k, _: k == F.col("path"))), F.lit(0))
    return pending.select("fp", F.explode(choice).alias("m")).select(
        F.col("m.path").alias("path"), F.col("fp").bitwiseAND(F.col("m.mask")).alias("key"), "fp"
    )


def _number(path: tuple[int, ...]) -> int:
    n = 1
    for t in path:
        n = n * 8 + t
    return n


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _bucket_edges(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    """Sorted (path, key, fp) rows to spanning edges; a bucket may continue in the next frame."""
    rest: pd.DataFrame | None = None
    for frame in frames:
        if rest is not None and len(rest):
            frame = pd.concat([rest, frame], ignore_index=True)
        if not len(frame):
            continue
        path, key = frame["path"].to_numpy(), frame["key"].to_numpy()
        last = np.flatnonzero((path != path[-1]) | (key != key[-1]))
        cut = last[-1] + 1 if len(last) else 0
        yield _edges_of(path[:cut], key[:cut], frame["fp"].to_numpy()[:cut])
        rest = frame.iloc[cut:]
    if rest is not None and len(rest):
        yield _edges_of(*(rest[name].to_numpy() for name in ("path", "key", "fp")))


def _edges_of(path: np.ndarray, key: np.ndarray, fp: np.ndarray) -> pd.DataFrame:
    if not len(fp):
        return pd.DataFrame({"a": np.array([], np.int64), "b": np.array([], np.int64)})
    starts = np.flatnonzero(np.r_[True, (path[1:] != path[:-1]) | (key[1:] != key[:-1])])
    sizes = np.diff(np.r_[starts, len(fp)])
    size_of = np.repeat(sizes, sizes)
    place = np.arange(len(fp)) - np.repeat(starts, sizes)
    bits = fp.view(np.uint64)
    a, b = [], []
    for shift in range(1, SMALL):
        left = np.flatnonzero((size_of <= SMALL) & (place + shift < size_of))
        if not len(left):
            break
        near = left[np.bitwise_count(bits[left] ^ bits[left + shift]) <= RADIUS]
        a.append(fp[near])
        b.append(fp[near + shift])
    for start, size in zip(starts[sizes > SMALL], sizes[sizes > SMALL]):
        own = bits[start : start + size]
        near = np.bitwise_count(own[:, None] ^ own[None, :]) <= RADIUS
        left = np.ones(size, bool)
        while left.any():
            seed = int(np.argmax(left))
            reached = np.zeros(size, bool)
            front = np.array([seed])
            reached[seed] = True
            while len(front):
                new = near[front].any(axis=0) & ~reached
                reached |= new
                front = np.flatnonzero(new)
            left &= ~reached
            others = np.flatnonzero(reached)[1:] + start
            a.append(np.full(len(others), fp[start + seed]))
            b.append(fp[others])
    return pd.DataFrame({"a": np.concatenate(a) if a else fp[:0], "b": np.concatenate(b) if b else fp[:0]})


def near_duplicate_groups(docs: DataFrame) -> DataFrame:
    """doc_id, _key_id, _key_text, fp, root, component_id for every row.

    component_id is the smallest doc_id reachable over links between fingerprints, null only where a
    component has no doc_id at all. Null and empty texts have fingerprint 0 and link like any other.
    Repeated rows share a fingerprint. Copies cost one node: links are sought between distinct
    fingerprints.
    """
    rows = stored(fingerprints(docs), "fingerprints")
    nodes = stored(rows.groupBy("fp").agg(F.min("doc_id").alias("least_id")), "nodes")
    roots = stored(connected_components(link_edges(nodes)), "roots")
    least = stored(
        roots.join(nodes, roots.node == nodes.fp).groupBy("root").agg(F.min("least_id").alias("component_id")), "least-id"
    )
    linked = stored(roots.join(least, "root").select(F.col("node").alias("fp"), "root", "component_id"), "components")
    single = nodes.join(linked, "fp", "left_anti").select(
        "fp", F.col("fp").alias("root"), F.col("least_id").alias("component_id")
    )
    groups = stored(linked.unionByName(single), "groups")
    return rows.join(groups, "fp")


def fingerprint_text() -> Column:
    """The fingerprint as 16 lowercase hex digits."""
    return F.lower(F.lpad(F.hex("fp"), 16, "0"))


def deduplicate(docs: DataFrame) -> DataFrame:
    """One document of each group: the one with the smallest doc_id, ties by a hash of the text.

    Groups are those of :func:`near_duplicate_groups`. All columns are kept. Rows that repeat a kept
    document (same doc_id and text) go. Only the keys of the kept documents are joined to the texts.
    """
    groups = near_duplicate_groups(docs)
    order = F.struct("_key_id", "_key_text")
    keep = stored(groups.groupBy("root").agg(F.min(order).alias("k")).select("k._key_id", "k._key_text"), "keep")
    kept = with_row_key(docs).join(keep, ["_key_id", "_key_text"], "left_semi")
    return kept.dropDuplicates(["_key_id", "_key_text"]).select(*docs.columns)
