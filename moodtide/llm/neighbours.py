"""Near-duplicate vectors by counting collisions of one-dimensional projections.

Two unit vectors at distance ``d`` differ by a normal number of deviation ``d`` along a Gaussian
direction, independently for each. A pair collides along a direction if one lies in the window
around the other; how many of ``PROJECTIONS`` windows a pair at the cosine limit shares is
binomial, which gives the count that it reaches but for a chance of ``MISS``. Pairs with that
count are verified by their cosine; all others are left.

Only vectors of one label are compared. The first projection cuts a label's sorted vectors into
cells no narrower than its widest window, so pairs lie in one cell or in neighbours; full cells are
cut into chunks, and a task compares two chunks. Along each direction a chunk is sorted and every
query's window found by binary search. Work still grows with the square of a cell.

Equal vectors are one class, compared once. A task returns one row per class, with the number of
vectors it links to and one link that joins it to the forest found: never the pairs.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import stored
from moodtide.llm.graph import components
from moodtide.llm.simhash import _hook

COSINE = 0.98
PROJECTIONS = 32
# A window's half width and the width of a cell, in distances of a pair at the cosine limit.
WINDOW = 1.5
CELL = 5.0
MISS = 1e-6
SEED = 20
CHUNK = 4096
# Queries whose counts, and pairs whose products, a task holds at a time.
QUERIES = 256
PAIRS = 1 << 14


def reach(cosine: float) -> float:
    """The distance of two unit vectors at ``cosine``."""
    return math.sqrt(2 - 2 * cosine)


def needed(projections: int = PROJECTIONS, window: float = WINDOW, miss: float = MISS) -> int:
    """The largest count that a pair at the limit falls short of with a chance of at most ``miss``."""
    p, below = math.erf(window / math.sqrt(2)), 0.0
    for count in range(projections + 1):
        below += math.comb(projections, count) * p**count * (1 - p) ** (projections - count)
        if below > miss:
            return count
    return projections


def directions(dim: int, projections: int = PROJECTIONS) -> np.ndarray:
    return np.random.default_rng([SEED, dim]).standard_normal((dim, projections))


def collisions(a: np.ndarray, b: np.ndarray, half: float) -> np.ndarray:
    """How many of ``a``'s windows each of ``b`` lies in: ``(len(a), len(b))`` counts, from
    projections ``(vectors, directions)``."""
    counts = np.zeros((len(a), len(b)), dtype=np.uint8)
    rows = np.arange(len(a))
    for i in range(a.shape[1]):
        order = np.argsort(b[:, i], kind="stable")
        line = b[order, i]
        marks = np.zeros((len(a), len(b) + 1), dtype=np.int8)
        marks[rows, np.searchsorted(line, a[:, i] - half, "left")] += 1
        marks[rows, np.searchsorted(line, a[:, i] + half, "right")] -= 1
        rank = np.empty(len(b), dtype=np.int64)
        rank[order] = np.arange(len(b))
        inside = np.cumsum(marks[:, :-1], axis=1, dtype=np.int8)
        counts += np.take(inside, rank, axis=1).view(np.uint8)
    return counts


def linked(vectors: np.ndarray, copies: np.ndarray, lower: int, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """Links between rows before ``lower`` and those from it on, or among all if it is 0: how
    many vectors each row links to, and the lowest row that it is joined to."""
    norms = np.sqrt(np.einsum("ij,ij->i", vectors, vectors))
    half = WINDOW * reach(cosine)
    seen = (vectors / norms[:, None]) @ directions(vectors.shape[1])
    add, label = np.zeros(len(vectors), dtype=np.int64), np.arange(len(vectors))
    least = needed()
    for at in range(0, lower or len(vectors), QUERIES):
        asks = np.arange(at, min(at + QUERIES, lower or len(vectors)))
        start = lower or at
        passed = collisions(seen[asks], seen[start:], half) >= least
        if not lower:
            passed &= np.arange(start, len(vectors))[None, :] > asks[:, None]
        first, second = np.nonzero(passed)
        first, second = asks[first], second + start
        for part in range(0, len(first), PAIRS):
            i, j = first[part : part + PAIRS], second[part : part + PAIRS]
            found = np.einsum("ij,ij->i", vectors[i], vectors[j]) / (norms[i] * norms[j]) >= cosine
            i, j = i[found], j[found]
            np.add.at(add, i, copies[j])
            np.add.at(add, j, copies[i])
            _hook(label, i, j)
    return add, label


def _place(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            cells = []
            for vector in batch.column(batch.schema.get_field_index("vector")).to_pylist():
                v = np.array(vector)
                along = float(v @ directions(len(v))[:, 0]) / math.sqrt(float(v @ v))
                cells.append(math.floor(along / (CELL * reach(cosine))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(cells, pa.int64())], names=[*batch.schema.names, "cell"]
            )

    return run


def _compare(cosine: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``block, upper, key, copies, vector`` sorted by the first two -> ``key, root, add``."""

        def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
            rows = pa.Table.from_batches(parts).combine_chunks()
            keys = np.array(rows["key"].to_pylist(), dtype=object)
            values = rows["vector"].chunk(0)
            vectors = values.flatten().to_numpy(zero_copy_only=False).reshape(len(keys), -1)
            upper = rows["upper"].to_numpy()
            lower = int((upper == 0).sum()) if upper[-1] >= 0 else 0
            # A block of two chunks of which one has no rows has nothing to compare.
            if lower == len(keys) or (upper[-1] >= 0 and not lower):
                add, label = np.zeros(len(keys), dtype=np.int64), np.arange(len(keys))
            else:
                add, label = linked(vectors, rows["copies"].to_numpy(), lower, cosine)
            some = np.flatnonzero(add)
            return pa.RecordBatch.from_arrays(
                [pa.array(keys[some].tolist(), pa.string()), pa.array(keys[label[some]].tolist(), pa.string()), pa.array(add[some])],
                names=["key", "root", "add"],
            )

        held, block = [], None
        for batch in batches:
            names = batch.column(0).to_pylist()
            at = 0
            while at < len(names):
                end = at
                while end < len(names) and names[end] == names[at]:
                    end += 1
                if held and block != names[at]:
                    yield links(held)
                    held = []
                block = names[at]
                held.append(batch.slice(at, end - at))
                at = end
        if held:
            yield links(held)

    return run


def classes(vectors: DataFrame) -> DataFrame:
    """``key, label, copies, low, vector``: the different vectors that can link, from ``vec_id,
    label, vector, key``."""
    usable = vectors.filter("key IS NOT NULL")
    return usable.groupBy("key", "label", "vector").agg(F.count("*").alias("copies"), F.min("vec_id").alias("low"))


def keyed(vectors: DataFrame, id_col: str, vec_col: str, label_col: str) -> DataFrame:
    """``vec_id, label, vector, key``; no key where a vector links with nothing."""
    doubles = vectors.select(
        F.col(id_col).cast("bigint").alias("vec_id"),
        F.col(label_col).alias("label"),
        F.col(vec_col).cast("array<double>").alias("vector"),
    )
    usable = F.expr(
        "label IS NOT NULL AND forall(vector, x -> x IS NOT NULL AND NOT isnan(x) AND abs(x) < double('infinity'))"
        " AND exists(vector, x -> x != 0)"
    )
    return doubles.withColumn("key", F.when(usable, F.md5(F.to_json(F.struct("label", "vector")))))


def block_rows(placed: DataFrame, chunk: int) -> DataFrame:
    """``block, upper, key, copies, vector``: each class in every block of two chunks that it is
    in. ``upper`` is -1 in a block of one chunk, else 0 or 1 for its side."""
    placed = placed.withColumn("size", F.size("vector"))
    counted = placed.groupBy("label", "size", "cell").agg(F.ceil(F.count("*") / chunk).cast("int").alias("cuts"))
    counted = stored(counted, "vector-cells")
    beside = counted
    for step, name in ((1, "next"), (-1, "last")):
        other = counted.select("label", "size", (F.col("cell") - step).alias("cell"), F.col("cuts").alias(name))
        beside = beside.join(other, ["label", "size", "cell"], "left")
    cut = placed.join(stored(beside, "vector-cells"), ["label", "size", "cell"])
    cut = cut.withColumn("own", F.pmod(F.xxhash64("key"), F.col("cuts")).cast("int"))
    blocks = F.expr(
        """
        concat(
          transform(sequence(0, cuts - 1), o -> struct(cell AS at, 0 AS step, least(own, o) AS i, greatest(own, o) AS j,
            CASE WHEN o = own THEN -1 WHEN own < o THEN 0 ELSE 1 END AS upper)),
          CASE WHEN next IS NULL THEN array() ELSE transform(sequence(0, next - 1), o ->
            struct(cell AS at, 1 AS step, own AS i, o AS j, 0 AS upper)) END,
          CASE WHEN last IS NULL THEN array() ELSE transform(sequence(0, last - 1), o ->
            struct(cell - 1 AS at, 1 AS step, o AS i, own AS j, 1 AS upper)) END)
        """
    )
    dealt = cut.select("label", "size", F.inline(blocks), "key", "copies", "vector")
    block = F.to_json(F.struct("label", "size", "at", "step", "i", "j"))
    return dealt.select(block.alias("block"), "upper", "key", "copies", "vector")


def near_vectors(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    label_col: str = "label",
    cosine: float = COSINE,
    chunk: int = CHUNK,
) -> DataFrame:
    """``vec_id, n_links, component_id, kept``: one row per row of ``vectors``.

    Vectors that are null, empty, zero or hold null or non-finite numbers, and those without a
    label, have no links and are their own component. Vectors of different length never link.
    Repeated rows link with each other. A component's id is its smallest that is not null, or null
    if it has none. An empty table gives no rows; other columns are not read.
    """
    rows = keyed(vectors, id_col, vec_col, label_col)
    distinct = stored(classes(rows), "vector-classes")
    placed = distinct.select("key", "label", "copies", "vector").mapInArrow(
        _place(cosine), f"key string, label {dict(distinct.dtypes)['label']}, copies bigint, vector array<double>, cell bigint"
    )
    dealt = block_rows(stored(placed, "vector-cells"), chunk).repartition("block").sortWithinPartitions("block", "upper")
    found = stored(dealt.mapInArrow(_compare(cosine), "key string, root string, add bigint"), "vector-links")
    roots = stored(components(found.select(F.col("key").alias("a"), F.col("root").alias("b"))), "vector-roots")
    added = found.groupBy("key").agg(F.sum("add").alias("added"))
    known = distinct.select("key", "copies", "low").join(added, "key", "left")
    known = known.join(roots, known.key == roots.node, "left").select(
        "key", F.coalesce("root", "key").alias("root"), "low", (F.coalesce("added", F.lit(0)) + F.col("copies") - 1).alias("links")
    )
    lowest = known.groupBy("root").agg(F.min("low").alias("component"))
    known = stored(known.join(lowest, "root").select(F.col("key").alias("known"), "links", "component"), "vector-known")
    joined = rows.select("vec_id", "key").join(known, F.col("key") == F.col("known"), "left")
    component = F.when(F.col("key").isNull(), F.col("vec_id")).otherwise(F.col("component"))
    return joined.select(
        "vec_id",
        F.coalesce("links", F.lit(0)).cast("bigint").alias("n_links"),
        component.alias("component_id"),
        F.col("vec_id").eqNullSafe(component).alias("kept"),
    )
