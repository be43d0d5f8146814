"""Embedding near-dedup by an epsilon grid order join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import BinaryType

from netpulse.llm.common import connected_components, stored

#: Leading principal directions that order and bound the blocks.
AXES = 8
#: Vectors in a stored block, and in the smallest interval of the recursion inside a pair of blocks.
BLOCK, LEAF = 1024, 64
#: Branching of the interval tree over runs, as a power of two.
BRANCH_BITS = 5
#: Neighbouring blocks that make a run at most, and neighbouring runs that one left run meets in a task.
RUN_BITS, TILE_BITS = 5, 2
#: Slack on the pruning distance, far above rounding errors.
SLACK = 1e-6


def _units(packed: list[bytes]) -> np.ndarray:
    raw = np.frombuffer(b"".join(packed), "<f4").reshape(len(packed), -1).astype(np.float64)
    return raw / np.linalg.norm(raw, axis=1, keepdims=True)


def _moments(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    sums: dict[int, np.ndarray] = {}
    for frame in frames:
        for _, part in frame.groupby("width"):
            unit = _units(list(part["packed"]))
            one = np.hstack([unit, np.ones((len(unit), 1))])
            sums[unit.shape[1]] = sums.get(unit.shape[1], 0) + one.T @ one
    for width, m in sums.items():
        rows, cols = np.triu_indices(width + 1)
        yield pd.DataFrame({"width": width, "i": rows, "j": cols, "s": m[rows, cols]})


def principal_axes(classes: DataFrame) -> dict[int, np.ndarray]:
    """Per vector width the leading eigenvectors of the covariance of all unit vectors.

    Partitions send sums of products, which are added up before the driver sees them: it receives
    one number per pair of dimensions, however many vectors there are.
    """
    sums = classes.select("packed", "width").mapInPandas(_moments, "width int, i int, j int, s double")
    rows = sums.groupBy("width", "i", "j").agg(F.sum("s").alias("s")).collect()
    axes = {}
    for width in {r.width for r in rows}:
        m = np.zeros((width + 1, width + 1))
        for r in rows:
            if r.width == width:
                m[r.i, r.j] = m[r.j, r.i] = r.s
        mean = m[:-1, -1] / m[-1, -1]
        _, vectors = np.linalg.eigh(m[:-1, :-1] / m[-1, -1] - np.outer(mean, mean))
        # a direction's sign is free; fix it so that reruns order alike
        lead = vectors[:, ::-1][:, :AXES]
        axes[width] = lead * np.where(lead[np.abs(lead).argmax(axis=0), range(lead.shape[1])] < 0, -1, 1)
    return axes


def _order_keys(axes: dict[int, np.ndarray], cell: float):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            for width, part in frame.groupby("width"):
                place = _units(list(part["packed"])) @ axes[width]
                place = np.pad(place, ((0, 0), (0, AXES - place.shape[1])))
                grid = np.floor(place / cell).astype(np.int32)
                yield part.assign(**{f"c{k}": grid[:, k] for k in range(AXES)})

    return run


def _pack_blocks(axes: dict[int, np.ndarray]):
    """Consecutive vectors of a sorted partition to blocks of one label, with bounding boxes."""

    def pack(rows: pd.DataFrame, part: int, number: int) -> dict:
        place = _units(list(rows["packed"])) @ axes[int(rows["width"].iloc[0])]
        place = np.pad(place, ((0, 0), (0, AXES - place.shape[1])))
        return {
            "label": rows["label"].iloc[0], "width": rows["width"].iloc[0], "part": part, "number": number,
            "n": len(rows), "ids": rows["vec_id"].to_numpy("<i8").tobytes(), "weights": rows["copies"].to_numpy("<i8").tobytes(),
            "vectors": b"".join(rows["packed"]),
            **{f"lo{k}": place[:, k].min() for k in range(AXES)}, **{f"hi{k}": place[:, k].max() for k in range(AXES)},
        }

    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        rest, number = None, 0
        for frame in frames:
            rest = frame if rest is None or not len(rest) else pd.concat([rest, frame], ignore_index=True)
            while len(rest):
                same = (rest["label"].to_numpy() == rest["label"].iloc[0]) & (rest["width"].to_numpy() == rest["width"].iloc[0])
                size = min(BLOCK, int(np.argmin(same)) if not same.all() else len(same))
                if size == len(rest) and size < BLOCK:
                    break  # may go on in the next frame
                yield pd.DataFrame([pack(rest.iloc[:size], int(rest["part"].iloc[0]), number)])
                rest, number = rest.iloc[size:].reset_index(drop=True), number + 1
        if rest is not None and len(rest):
            yield pd.DataFrame([pack(rest, int(rest["part"].iloc[0]), number)])

    return run


_BLOCK_TYPE = "label int, width int, part int, number int, n int, ids binary, weights binary, vectors binary, " + ", ".join(
    f"{side}{k} double" for side in ("lo", "hi") for k in range(AXES)
)


def grid_order_blocks(classes: DataFrame, reach: float) -> DataFrame:
    """Distinct vectors in grid order, cut into stored blocks with the box each one fills."""
    axes = principal_axes(classes)
    cells = [f"c{k}" for k in range(AXES)]
    keyed = classes.mapInPandas(
        _order_keys(axes, reach), classes.schema.simpleString()[7:-1].replace(":", " ") + "".join(f", {c} int" for c in cells)
    )
    order = ["label", "width", *cells, "vec_id"]
    ranged = keyed.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("part", F.spark_partition_id())
    return stored(ranged.mapInPandas(_pack_blocks(axes), _BLOCK_TYPE), "blocks")


def _gap(reach: float) -> Column:
    """Boxes l and r are within reach: the squared gaps over all axes add up to less."""
    total = F.lit(0.0)
    for k in range(AXES):
        apart = F.greatest(F.col(f"l.lo{k}") - F.col(f"r.hi{k}"), F.col(f"r.lo{k}") - F.col(f"l.hi{k}"), F.lit(0.0))
        total = total + apart * apart
    return total <= (reach + SLACK) ** 2


def with_runs(blocks: DataFrame) -> DataFrame:
    """Add ``at``: blocks in a row that hold about BLOCK vectors together share one, full blocks have their own.

    A run is the blocks of a label and width that share ``at``, 2^RUN_BITS of them at most. Sparse range
    partitions leave blocks far below BLOCK; taken alone, each of them would meet each.
    """
    found = blocks.agg(F.max("number").alias("number"), F.max("part").alias("part"), F.sum("n").alias("n")).first()
    bits = (found.number or 0).bit_length()
    mean = (found.n or 0) / (((found.part or 0) + 1) << bits)
    spare = max(0, int(BLOCK / max(mean, 1e-9)).bit_length() - 1)
    place = F.shiftleft(F.col("part").cast("bigint"), bits) + F.col("number")
    return blocks.withColumns({"place": place, "at": F.shiftright(place, min(spare, RUN_BITS))})


def run_pairs(blocks: DataFrame, reach: float) -> DataFrame:
    """Pairs of runs (left, right; left <= right) that may hold vectors within reach.

    Recursion over the ordered sequence: its intervals form a tree, and a pair of intervals is
    divided further only while their boxes are close enough. Both ends of every step are equi-joins
    on the parent interval. The boxes of all levels are one table, made from the blocks at once.
    """
    boxes = [x for k in range(AXES) for x in (F.min(f"lo{k}").alias(f"lo{k}"), F.max(f"hi{k}").alias(f"hi{k}"))]
    leaves = blocks.select("label", "width", "at", *[f"{s}{k}" for s in ("lo", "hi") for k in range(AXES)])
    depth = -(-(leaves.agg(F.max("at")).first()[0] or 0).bit_length() // BRANCH_BITS)

    above = F.explode(F.array(*[F.struct(F.lit(up).alias("level"), F.shiftright("at", up * BRANCH_BITS).alias("at")) for up in range(depth + 1)]))
    every = leaves.withColumn("node", above).select("label", "width", "node.*", *[f"{s}{k}" for s in ("lo", "hi") for k in range(AXES)])
    tree = stored(every.groupBy("level", "label", "width", "at").agg(*boxes), "tree")

    def level(up: int) -> DataFrame:
        return tree.where(F.col("level") == up).withColumn("up", F.shiftright("at", BRANCH_BITS))

    # the one interval at the top of each label is paired with itself
    top = level(depth).select("label", "width", F.col("at").alias("x"), F.col("at").alias("y"))
    for up in range(depth - 1, -1, -1):
        nodes = level(up)
        left = top.alias("p").join(nodes.alias("l"), F.expr("p.label = l.label AND p.width = l.width AND p.x = l.up"))
        left = left.select("p.y", "l.*").alias("l")
        near = (F.col("l.at") <= F.col("r.at")) & _gap(reach)
        both = left.join(nodes.alias("r"), F.expr("l.label = r.label AND l.width = r.width AND l.y = r.up") & near)
        top = stored(both.select("l.label", "l.width", F.col("l.at").alias("x"), F.col("r.at").alias("y")), "intervals")
    return top


def _within(left: np.ndarray, right: np.ndarray, same: bool, least: float, pl: np.ndarray, pr: np.ndarray, reach: float):
    """Index pairs with cosine >= least, by recursion over halves; distant intervals are skipped."""
    stack = [(0, len(left), 0, len(right))]
    while stack:
        a, b, c, d = stack.pop()
        if same and d <= a:
            continue
        apart = np.maximum(np.maximum(pl[a:b].min(0) - pr[c:d].max(0), pr[c:d].min(0) - pl[a:b].max(0)), 0)
        if apart @ apart > (reach + SLACK) ** 2:
            continue
        if b - a <= LEAF and d - c <= LEAF:
            i, j = np.nonzero(left[a:b] @ right[c:d].T >= least)
            i, j = i + a, j + c
            yield (i[i < j], j[i < j]) if same else (i, j)
            continue
        m, k = (a + b) // 2, (c + d) // 2
        firsts = [(a, m), (m, b)] if b - a > LEAF else [(a, b)]
        seconds = [(c, k), (k, d)] if d - c > LEAF else [(c, d)]
        stack.extend((*x, *y) for x in firsts for y in seconds)


def _join_runs(least: float, reach: float):
    """Links between a left run and a few right runs: per vector their number, and a mate of a spanning forest."""

    def run(tile: pd.DataFrame) -> pd.DataFrame:
        tile = tile.sort_values(["y", "place"], kind="stable")
        is_left = (tile["side"] == 0).to_numpy()
        out = []
        left = _Run(tile[is_left])
        if (tile["x"] == tile["y"]).any():
            out.append(left.links(left, least, reach))
        for _, rows in tile[~is_left].groupby("y"):
            out.append(left.links(_Run(rows), least, reach))
        return pd.concat(out, ignore_index=True)

    return run


class _Run:
    """The vectors of some blocks in a row."""

    def __init__(self, blocks: pd.DataFrame):
        self.ids = np.frombuffer(b"".join(blocks["ids"]), "<i8")
        self.copies = np.frombuffer(b"".join(blocks["weights"]), "<i8")
        raw = np.frombuffer(b"".join(blocks["vectors"]), "<f4").reshape(len(self.ids), -1).astype(np.float64)
        self.unit = raw / np.linalg.norm(raw, axis=1, keepdims=True)

    def links(self, right: _Run, least: float, reach: float) -> pd.DataFrame:
        same = right is self
        center = self.unit.mean(axis=0)
        # local leading directions bound the halves; any orthonormal ones keep the bound right
        some = np.vstack([x[:: max(1, len(x) // 128)] for x in (self.unit, right.unit)])
        lead = np.linalg.svd(some - center, full_matrices=False)[2][:AXES]
        places = [(x - center) @ lead.T for x in (self.unit, right.unit)]
        shift = 0 if same else len(self.ids)
        every = self.ids if same else np.concatenate([self.ids, right.ids])
        total, parent = np.zeros(len(every), np.int64), np.arange(len(every))
        for i, j in _within(self.unit, right.unit, same, least, *places, reach):
            if not len(i):
                continue
            np.add.at(total, i, right.copies[j])
            np.add.at(total, j + shift, self.copies[i])
            parent = _merge(parent, i, j + shift)
        hit = np.flatnonzero(total)
        return pd.DataFrame({"vec_id": every[hit], "links": total[hit], "mate": every[parent[hit]]})


def _merge(parent: np.ndarray, i: np.ndarray, j: np.ndarray) -> np.ndarray:
    """Join the trees of i and j by least root, until every pair shares one."""
    while True:
        a, b = parent[i], parent[j]
        if (a == b).all():
            return parent
        low, high = np.minimum(a, b), np.maximum(a, b)
        parent = parent.copy()
        np.minimum.at(parent, high, low)
        while (parent[parent] != parent).any():
            parent = parent[parent]


def near_duplicate_vectors(vectors: DataFrame, least: float = 0.93) -> DataFrame:
    """vec_id, n_links, component_id, kept, one row per row of ``vectors`` (vec_id, embedding, label).

    Unit vectors with cosine >= c lie within sqrt(2 - 2c) of each other, and an orthonormal
    projection never lengthens a distance, so distant grid intervals are skipped without losing a
    pair. Equal vectors of a label are one class in the join and count as each other's links. A
    pair of runs returns link counts and a spanning forest: rows grow with the vectors, not with
    their pairs. The cosine is taken in double precision.

    A vector without label, without id, null, all zero or with a null or non-finite component links
    with nothing: n_links 0, component_id its own id. Vectors of different width never link. Rows
    sharing a vec_id are treated as one vertex. Extra columns are ignored.
    """
    reach = float(np.sqrt(2 - 2 * least))
    rows = vectors.select("vec_id", F.col("embedding").cast("array<float>").alias("embedding"), F.col("label").cast("int").alias("label"))
    rows = rows.withColumn("packed", F.when(F.col("label").isNotNull() & F.col("vec_id").isNotNull(), _pack("embedding")))
    usable = rows.where("packed IS NOT NULL")
    # a class per label and vector: -0.0 equals 0.0
    classes = stored(
        usable.groupBy("label", "packed").agg(F.min("vec_id").alias("vec_id"), F.count("*").alias("copies"))
        .select("label", "packed", F.expr("cast(length(packed) / 4 as int)").alias("width"), "vec_id", "copies"),
        "classes",
    )
    blocks = with_runs(grid_order_blocks(classes, reach))
    pairs = run_pairs(blocks, reach)
    # a left run goes to a task once for 2^TILE_BITS right ones
    kind = ["label", "width"]
    tile = pairs.select(*kind, "x", F.shiftright("y", TILE_BITS).alias("tile"), "y")
    lefts = tile.groupBy(*kind, "x", "tile").agg(F.max(F.when(F.col("x") == F.col("y"), F.col("y"))).alias("itself"))
    lefts = lefts.select(*kind, F.col("x").alias("at"), "x", "tile", F.coalesce("itself", F.lit(-1)).alias("y"), F.lit(0).alias("side"))
    rights = tile.where("x <> y").select(*kind, F.col("y").alias("at"), "x", "tile", "y", F.lit(1).alias("side"))
    work = blocks.select(*kind, "at", "place", "ids", "weights", "vectors").join(lefts.unionByName(rights), [*kind, "at"])
    joined = work.groupBy(*kind, "x", "tile").applyInPandas(_join_runs(least, reach), "vec_id bigint, links bigint, mate bigint")
    found = stored(joined, "links")

    roots = connected_components(found.select(F.col("vec_id").alias("a"), F.col("mate").alias("b")))
    counts = found.groupBy("vec_id").agg(F.sum("links").alias("links"))
    per_class = stored(
        classes.select("label", "packed", "vec_id", "copies")
        .join(counts, "vec_id", "left")
        .join(roots.withColumnRenamed("node", "vec_id"), "vec_id", "left")
        .where("links IS NOT NULL OR copies > 1")
        .select(
            F.col("label").alias("_label"), F.col("packed").alias("_packed"), F.coalesce("root", "vec_id").alias("_root"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("_links"),
        ),
        "per-class",
    )
    result = rows.join(per_class, F.expr("label = _label AND packed = _packed"), "left")
    component = F.coalesce("_root", "vec_id")
    return result.select(
        "vec_id", F.coalesce("_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
        F.coalesce(F.col("vec_id") == component, F.lit(False)).alias("kept"),
    )


@F.pandas_udf(BinaryType())
def _pack(vectors: pd.Series) -> pd.Series:
    """Little-endian float32 components; null for vectors that cannot link."""

    def one(v) -> bytes | None:
        if v is None:
            return None
        v = np.asarray(v, "<f4") + np.float32(0)
        return v.tobytes() if np.isfinite(v).all() and v.any() else None

    return vectors.map(one)
