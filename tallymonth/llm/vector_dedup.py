"""Near-duplicate vectors through a pivot-permutation index.

Vectors are centred on the mean of a bounded sample, whose members are also the reference
points (pivots): so vectors that all lie in one narrow cone are told apart by where they
are in it. Each vector is described by the order of its nearest pivots and written to
inverted lists. Two vectors are candidates if their descriptions share ``min_shared`` pivots,
and are linked if their cosine (not centred), in double precision, reaches the threshold.

The recall of a description is measured before it is used: all links of a bounded number of
vectors, against all vectors, are held against what the index would retrieve. Below
``LEAST_RECALL`` longer descriptions and fewer shared pivots are tried, at last a single list in
which everything is compared.

A list belongs to a pivot; where the vectors are so many that such lists would be long, to a
pair of pivots, which gives the same candidates from shorter lists. A pair of vectors is
counted in the first of its shared lists alone. Long lists are cut into blocks, and each two
blocks meet in a task of their own, so no task holds a whole list; what leaves a task
are counts and a spanning forest of its links, not its pairs.

Fixed to the input: the sample is the ``SAMPLE`` vectors with the smallest hashes, and
the number of pivots follows the square root of the number of vectors, so that
describing and comparing cost alike, up to ``MOST_PIVOTS``.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallymonth.llm.common import stored
from tallymonth.llm.components import connected_components

SAMPLE = 8192
MOST_PIVOTS = 4096
NEAREST = 8
MIN_SHARED = 2
BLOCK = 1000
PAIRS_AT_ONCE = 1 << 16
NO_PIVOT = np.iinfo(np.int32).max

# Pivots at least this far apart, when centred: copies in the sample are one pivot.
PIVOT_COSINE = 0.6

# Expected vectors of a list beyond which lists belong to pairs of pivots.
LONG_LIST = 20_000

# Vectors whose links are counted exactly to measure recall, and what must be found of these.
PROBES = 256
LEAST_RECALL = 0.97

# (nearest pivots, pivots to share) that are tried in turn.
DESCRIPTIONS = [(NEAREST, MIN_SHARED), (2 * NEAREST, MIN_SHARED), (2 * NEAREST, 1)]


def usable(vector: Column) -> Column:
    """Neither null nor zero, no component null, infinite or no number."""
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def _unit(rows: np.ndarray) -> np.ndarray:
    # Scaled first, so that squares neither overflow nor vanish.
    rows = rows / np.abs(rows).max(axis=1, keepdims=True)
    return rows / np.linalg.norm(rows, axis=1, keepdims=True)


@dataclass(frozen=True)
class Index:
    centre: np.ndarray
    pivots: np.ndarray  # unit vectors, centred
    nearest: int
    min_shared: int

    def describe(self, vectors: np.ndarray) -> np.ndarray:
        """Numbers of the nearest pivots of unit vectors, nearest first; ties by number."""
        width = min(self.pivots.shape[1], vectors.shape[1])
        centred = vectors[:, :width] - self.centre[:width]
        same = centred @ self.pivots[:, :width].T
        return np.argsort(-same, axis=1, kind="stable")[:, : self.nearest].astype(np.int32)


def fit(classes: DataFrame, count: int, nearest: int, min_shared: int, sample: int = SAMPLE) -> Index:
    """An index for ``count`` vectors, from at most ``sample`` of them."""
    drawn = classes.select("vector", F.xxhash64("vector").alias("h")).orderBy("h", "vector")
    rows = [row["vector"] for row in drawn.limit(sample).collect()]
    wanted = min(MOST_PIVOTS, max(4 * nearest, 2 * math.isqrt(count)))
    width = max(map(len, rows), default=1)
    units = np.zeros((len(rows), width))
    for at, row in enumerate(rows):
        units[at, : len(row)] = _unit(np.array([row], np.float64))[0]
    centre = units.mean(axis=0) if len(units) else np.zeros(width)
    centred = units - centre
    length = np.linalg.norm(centred, axis=1, keepdims=True)
    centred = np.divide(centred, length, out=np.zeros_like(centred), where=length > 1e-12)
    chosen: list[int] = []
    closest = np.full(len(rows), -np.inf)
    for at in range(len(rows)):
        if closest[at] < PIVOT_COSINE and (length[at] > 1e-12 or not chosen):
            chosen.append(at)
            closest = np.maximum(closest, centred @ centred[at])
        if len(chosen) == wanted:
            break
    pivots = centred[chosen].reshape(-1, width)
    return Index(centre, pivots, nearest, max(1, min(min_shared, len(pivots))))


def single_list(index: Index) -> Index:
    """The index of one pivot, in whose list everything is compared."""
    return Index(index.centre, index.pivots[:1], 1, 1)


def measured_recall(described: DataFrame, index: Index, threshold: float, probes: int = PROBES) -> float:
    """What share of the links of a bounded number of vectors the index retrieves; 1 without links.

    The probes are the vectors with the smallest hashes; they are compared with all vectors.
    """
    drawn = described.select("unit", "nearest", "node").orderBy(F.xxhash64("unit"), "node").limit(probes)
    rows = drawn.collect()
    by_width: dict[int, tuple] = {}
    for width in {len(row["unit"]) for row in rows}:
        alike = [row for row in rows if len(row["unit"]) == width]
        by_width[width] = (
            np.array([row["unit"] for row in alike]), np.array([row["nearest"] for row in alike]),
            np.array([row["node"] for row in alike], object),
        )
    sent = described.sparkSession.sparkContext.broadcast(by_width)
    min_shared = index.min_shared

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        links = found = 0
        for part in parts:
            units, near = part.column("unit").to_pylist(), part.column("nearest").to_pylist()
            nodes = part.column("node").to_pylist()
            for width, (probe, probe_near, probe_node) in sent.value.items():
                here = [at for at, unit in enumerate(units) if len(unit) == width]
                if not here:
                    continue
                linked = np.array([units[at] for at in here]) @ probe.T >= threshold
                linked &= np.array([nodes[at] for at in here], object)[:, None] != probe_node[None, :]
                i, j = np.nonzero(linked)
                links += len(i)
                for cut in range(0, len(i), PAIRS_AT_ONCE):
                    some = slice(cut, cut + PAIRS_AT_ONCE)
                    own = np.array([near[here[at]] for at in i[some].tolist()])
                    shared = (own[:, :, None] == probe_near[j[some]][:, None, :]).any(axis=2)
                    found += int((shared.sum(axis=1) >= min_shared).sum())
        yield pa.RecordBatch.from_pydict({"links": [links], "found": [found]})

    counted = described.select("unit", "nearest", "node").mapInArrow(batches, "links long, found long")
    sums = counted.agg(F.sum("links").alias("links"), F.sum("found").alias("found")).first()
    return sums["found"] / sums["links"] if sums["links"] else 1.0


def described_well(
    classes: DataFrame, threshold: float, descriptions: list[tuple[int, int]] | None = None
) -> tuple[DataFrame, Index, int]:
    """The described classes, the first index of enough recall, and how many classes there are."""
    count = classes.count()
    for nearest, min_shared in descriptions or DESCRIPTIONS:
        index = fit(classes, count, nearest, min_shared)
        described = stored(_described(classes, index), "described")
        if measured_recall(described, index, threshold) >= LEAST_RECALL:
            return described, index, count
    index = single_list(index)
    return stored(_described(classes, index), "described"), index, count


def _described(classes: DataFrame, index: Index) -> DataFrame:
    """(node, copies, unit, nearest) of (node, copies, vector)."""
    sent = classes.sparkSession.sparkContext.broadcast(index)
    kind = classes.schema["node"].dataType.simpleString()

    def batches(parts: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in parts:
            for at in range(0, len(whole), 1024):
                part = whole.slice(at, 1024)
                vectors = [_unit(np.array([v], np.float64))[0] for v in part.column("vector").to_pylist()]
                widths = {len(v) for v in vectors}
                near: list[list[int]] = [[]] * len(vectors)
                for width in widths:
                    here = [i for i, v in enumerate(vectors) if len(v) == width]
                    found = sent.value.describe(np.array([vectors[i] for i in here]))
                    for i, pivots in zip(here, found.tolist(), strict=True):
                        near[i] = pivots
                columns = [
                    part.column("node"),
                    part.column("copies"),
                    pa.array(vectors, pa.list_(pa.float64())),
                    pa.array(near, pa.list_(pa.int32())),
                ]
                yield pa.RecordBatch.from_arrays(columns, ["node", "copies", "unit", "nearest"])

    return classes.mapInArrow(
        batches, f"node {kind}, copies long, unit array<double>, nearest array<int>"
    )


def _forest(size: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The smallest place each place is linked to over pairs (a, b)."""
    label = np.arange(size)
    while True:
        before = label.copy()
        np.minimum.at(label, a, label[b])
        np.minimum.at(label, b, label[a])
        label = label[label]
        if (label == before).all():
            return label


def _compare(threshold: float, min_shared: int, in_pairs: bool):
    def compare(key: tuple, group: pd.DataFrame) -> pd.DataFrame:
        """Links of one list between two blocks, or within one."""
        list_key, first, second = key
        group = group.sort_values("node", kind="stable", ignore_index=True)
        unit_of, near_of = group["unit"], group["nearest"]
        block, node = group["block"].to_numpy(), group["node"].to_numpy()
        copies = group["copies"].to_numpy()
        links, a_all, b_all = np.zeros(len(group), np.int64), [], []
        width = unit_of.map(len).to_numpy()
        for size in np.unique(width):
            left = np.flatnonzero((width == size) & (block == first))
            right = np.flatnonzero((width == size) & (block == second))
            if not len(left) or not len(right):
                continue
            right_units, right_near = np.stack(unit_of[right]), np.stack(near_of[right])
            for at in range(0, len(left), 250):
                rows = left[at : at + 250]
                cosine = np.stack(unit_of[rows]) @ right_units.T
                i, j = np.nonzero(cosine >= threshold)
                a, b = rows[i], right[j]
                if first == second:
                    once = a < b
                    a, b, j = a[once], b[once], j[once]
                for cut in range(0, len(a), PAIRS_AT_ONCE):
                    some = slice(cut, cut + PAIRS_AT_ONCE)
                    own = np.stack(near_of[a[some]])
                    shared = (own[:, :, None] == right_near[j[some]][:, None, :]).any(axis=2)
                    least = np.sort(np.where(shared, own, NO_PIVOT), axis=1).astype(np.int64)
                    named = (least[:, 0] << 32) + least[:, 1] if in_pairs else least[:, 0]
                    good = (shared.sum(axis=1) >= min_shared) & (named == list_key)
                    a_all.append(a[some][good])
                    b_all.append(b[some][good])
        if not a_all:
            return pd.DataFrame({"node": node[:0], "links": links[:0], "root": node[:0]})
        a, b = np.concatenate(a_all), np.concatenate(b_all)
        np.add.at(links, a, copies[b])
        np.add.at(links, b, copies[a])
        root = _forest(len(group), a, b)
        some = links > 0
        return pd.DataFrame({"node": node[some], "links": links[some], "root": node[root[some]]})

    return compare


def _list_keys(in_pairs: bool) -> Column:
    """The lists a description is in: one for each of its pivots, or for each two of them."""
    if not in_pairs:
        return F.transform("nearest", lambda pivot: pivot.cast("long"))
    ordered = F.array_sort("nearest")
    return F.flatten(
        F.transform(
            ordered,
            lambda a, i: F.transform(
                F.slice(ordered, i + 2, F.size(ordered)),
                lambda b: F.shiftleft(a.cast("long"), 32) + b,
            ),
        )
    )


def _lists(described: DataFrame, block: int, in_pairs: bool) -> DataFrame:
    """Every vector in its lists, once for each block it meets."""
    listed = described.withColumn("list", F.explode(_list_keys(in_pairs)))
    counts = described.select(F.explode(_list_keys(in_pairs)).alias("list")).groupBy("list")
    sizes = counts.agg(F.ceil(F.count("*") / block).cast("int").alias("blocks"))
    cut = listed.join(sizes, "list").withColumn(
        "block", F.pmod(F.xxhash64("node"), F.col("blocks").cast("long")).cast("int")
    )
    others = F.sequence(F.lit(0), F.col("blocks") - 1)
    met = cut.withColumn("other", F.explode(others))
    return met.select(
        "list",
        F.least("block", "other").alias("first"),
        F.greatest("block", "other").alias("second"),
        "block",
        "node",
        "copies",
        "unit",
        "nearest",
    )


def near_vectors(
    rows: DataFrame,
    threshold: float = 0.9,
    descriptions: list[tuple[int, int]] | None = None,
    block: int = BLOCK,
    long_list: int = LONG_LIST,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
) -> DataFrame:
    """One row per vector: vec_id, n_links, component_id, kept.

    ``n_links`` counts the other vectors linked directly, equal ones too; these are one
    node of the index and never compared. ``component_id`` is the smallest vec_id
    reachable. An empty table gives an empty result; other columns are not read, so their names
    may be any. ``descriptions`` are (nearest pivots, pivots to share), tried in turn until
    recall is enough. Vectors that are null, zero or hold a null or non-finite component,
    and vectors of different lengths, link with nothing. A row without an id links with
    nothing, and its component is null; it is kept. Rows that repeat an id with
    another vector tie these vectors together.
    """
    all_rows = rows.select(F.col(id_col).alias("vec_id"), F.col(vector_col).alias("vector"))
    fit_for_it = usable(F.col("vector")) & F.col("vec_id").isNotNull()
    good = all_rows.filter(fit_for_it)
    classes = stored(
        good.groupBy("vector").agg(F.min("vec_id").alias("node"), F.count("*").alias("copies")),
        "vectors",
    )
    described, index, count = described_well(classes, threshold, descriptions)
    expected = count * index.nearest / max(1, len(index.pivots))
    in_pairs = index.min_shared >= 2 and expected > long_list
    kind = classes.schema["node"].dataType.simpleString()
    found = stored(
        _lists(described, block, in_pairs)
        .groupBy("list", "first", "second")
        .applyInPandas(
            _compare(threshold, index.min_shared, in_pairs),
            f"node {kind}, links long, root {kind}",
        ),
        "vector-links",
    )
    links = found.groupBy("node").agg(F.sum("links").alias("links"))
    roots = connected_components(found.select(F.col("node").alias("a"), F.col("root").alias("b")))
    named = (
        classes.join(links, "node", "left")
        .join(roots, "node", "left")
        .select(
            F.col("vector"),
            (F.coalesce("links", F.lit(0)) + F.col("copies") - 1).alias("n_links"),
            F.coalesce("component", "node").alias("component_id"),
        )
    )
    linked = good.join(named, "vector").select("vec_id", "n_links", "component_id")
    alone = all_rows.filter(~fit_for_it).select(
        "vec_id", F.lit(0).cast("long").alias("n_links"), F.col("vec_id").alias("component_id")
    )
    return linked.unionByName(alone).withColumn(
        "kept", F.col("vec_id").eqNullSafe(F.col("component_id"))
    )
