"""Hard negatives by zone maps over candidate blocks in Hilbert order.

Candidates of one label are sorted along a Hilbert curve through their ``DIMS`` most varied dimensions and cut into
blocks of at most ``BLOCK``, written as Parquet with the least and greatest value of every dimension in the block's first
row: reading the zone maps reads these columns alone. By interval arithmetic an anchor's inner products
with a block lie between the sums of ``min`` and of ``max`` of ``a * low`` and ``a * high`` over the dimensions.

Positives come first: an anchor is compared with its own block, which leaves a score to beat, and then with
those blocks of its label that may beat it. Each positive's score makes a window of scores, and the
blocks of other labels whose interval meets a window are read for it. A task holds one block at a time and
streams the anchors that read it. Equal vectors of a label are one candidate with its smallest ids.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.llm.common import stored
from moodtide.llm.vector_rows import classes, matrix, products, runs, sample, whole, without_own

POSITIVES = 5
NEGATIVES = 5
# A negative scores from so many hundredths of the positive's score up to all of it.
LEAST = 80
DIMS = 8
BITS = 4
BLOCK = 1024
# Zone maps that a task compares anchors with at a time; anchors compared with a block at a time.
ZONES = 512
ANCHORS = 256


def hilbert(cells: np.ndarray, bits: int = BITS) -> np.ndarray:
    """Places along the Hilbert curve of points with coordinates below ``2**bits``, a row each: Gray-coded from the
    top bit down, the lower bits of the axes exchanged or reflected as the curve turns."""
    x = cells.T.astype(np.int64).copy()
    dims = len(x)
    for level in range(bits - 1, 0, -1):
        bit, below = 1 << level, (1 << level) - 1
        for axis in range(dims):
            turned = (x[axis] & bit) > 0
            swap = np.where(turned, 0, (x[0] ^ x[axis]) & below)
            x[0] ^= np.where(turned, below, swap)
            x[axis] ^= swap
    for axis in range(1, dims):
        x[axis] ^= x[axis - 1]
    flip = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, 0, -1):
        flip ^= np.where(x[-1] & (1 << level), (1 << level) - 1, 0)
    x ^= flip
    key = np.zeros(x.shape[1], dtype=np.int64)
    for level in range(bits - 1, -1, -1):
        for axis in range(dims):
            key = key << 1 | (x[axis] >> level & 1)
    return key


class Curve:
    """The most varied dimensions of a sample, and where they are cut into equal shares of it."""

    def __init__(self, some: np.ndarray) -> None:
        self.dims = np.sort(np.argsort(-some.astype(np.float64).var(0), kind="stable")[:DIMS])
        self.edges = np.quantile(some[:, self.dims], np.arange(1, 1 << BITS) / (1 << BITS), axis=0)

    def places(self, vectors: np.ndarray) -> np.ndarray:
        cells = [np.searchsorted(self.edges[:, i], vectors[:, dim], "right") for i, dim in enumerate(self.dims)]
        return hilbert(np.stack(cells, axis=1))


def intervals(anchors: np.ndarray, low: np.ndarray, high: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The least and greatest inner product that each anchor can have with a vector in each zone."""
    up, down = np.maximum(anchors, 0), np.minimum(anchors, 0)
    return products(up, low) + products(down, high), products(up, high) + products(down, low)


def _curve(curves: dict[int, Curve]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("vector"))
            sizes = column.value_lengths().to_numpy()
            place = np.zeros(len(sizes), dtype=np.int64)
            for size in np.unique(sizes):
                if int(size) in curves:
                    rows = np.flatnonzero(sizes == size)
                    place[rows] = curves[int(size)].places(matrix(column.take(pa.array(rows))))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int32()), pa.array(place)], names=[*batch.schema.names, "size", "place"]
            )

    return run


def best(scores: np.ndarray, ids: list[list[int]], order: np.ndarray, top: int, low: int, high: int) -> list[tuple[int, int, int, int]]:
    """The ``top`` first ``score, id, row``, and which of the row's ids, from ``low`` to ``high``, by score and then the smaller id; ``order`` sorts the
    rows by score, the highest first, and then by their smallest id."""
    at = int(np.searchsorted(-scores[order], -high, "left"))
    rows = [row for row in order[at : at + top].tolist() if scores[row] >= low]
    found = ((int(scores[row]), key, row, nth) for row in rows for nth, key in enumerate(ids[row]))
    return sorted(found, key=lambda e: (-e[0], e[1]))[:top]


_FOUND = "array<struct<score: bigint, vec_id: bigint, same: boolean>>"
_FOUND_TYPE = pa.list_(pa.struct([("score", pa.int64()), ("vec_id", pa.int64()), ("same", pa.bool_())]))
_ROWS = (
    "size int, label bigint, block string, vector array<bigint>, ids array<bigint>, k1 bigint, k2 bigint, asks boolean, "
    f"low array<bigint>, high array<bigint>, found {_FOUND}"
)
_LIST = pa.list_(pa.int64())
LOWEST, HIGHEST = -(1 << 63), (1 << 63) - 1


def _cut(top: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``size, label, k1, k2, vector, ids, asks`` in order -> the same in blocks, zone maps in the first row of each,
        and for each anchor the best of its own block."""
        number, held, count, key = 0, [], 0, None

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            vectors, ids = matrix(rows.column(4)), rows.column(5).to_pylist()
            n, firsts = len(ids), np.array([some[0] for some in ids])
            asks = np.flatnonzero(rows.column(6).to_numpy(zero_copy_only=False)).tolist()
            found: list = [None] * n
            for at in range(0, len(asks), ANCHORS):
                some = asks[at : at + ANCHORS]
                for row, scores in zip(some, products(vectors[some], vectors), strict=True):
                    order = np.lexsort((firsts, -scores))
                    found[row] = [
                        {"score": s, "vec_id": i, "same": other == row}
                        for s, i, other, _ in best(scores, ids, order, top, LOWEST, HIGHEST)
                    ]
            rest = [None] * (n - 1)
            name = f"{TaskContext.get().partitionId()}-{number}"
            return pa.RecordBatch.from_arrays(
                [
                    rows.column(0), rows.column(1), pa.array([name] * n), *(rows.column(i) for i in (4, 5, 2, 3, 6)),
                    pa.array([vectors.min(0).tolist(), *rest], _LIST), pa.array([vectors.max(0).tolist(), *rest], _LIST),
                    pa.array(found, _FOUND_TYPE),
                ],
                names="size label block vector ids k1 k2 asks low high found".split(),
            )

        for batch in batches:
            spots = list(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True))
            at = 0
            while at < len(spots):
                if held and (spots[at] != key or count == most):
                    yield done()
                    number, held, count = number + 1, [], 0
                key, end = spots[at], at
                while end < len(spots) and spots[end] == key and count < most:
                    end, count = end + 1, count + 1
                held.append(batch.slice(at, end - at))
                at = end
        if held:
            yield done()

    return run


def _choose(same_label: bool):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A page's zone maps, then its anchors ``page, kind, block, label, low, high, k1, k2, windows``: the anchor's vector
        is in ``low``. -> ``block`` and the anchor, wherever a window may hold scores of the block."""
        page, parts, zones = None, [], None
        for number, some in runs(batches):
            if number != page:
                page, parts, zones = number, [], None
            kind = some.column(1).to_numpy()
            first = int(np.searchsorted(kind, 1))
            if first:
                parts.append(some.slice(0, first))
            if first == len(kind):
                continue
            if not parts:
                continue
            if zones is None:
                held = pa.Table.from_batches(parts).combine_chunks()
                zones = [held[name].chunk(0) for name in ("block", "low", "high")]
                labels = held["label"].to_numpy()
                low, high = matrix(zones[1]), matrix(zones[2])
            asks = some.slice(first)
            for at in range(0, asks.num_rows, ANCHORS):
                part = asks.slice(at, ANCHORS)
                under, over = intervals(matrix(part.column(4)), low, high)
                fits = (part.column(3).to_numpy()[:, None] == labels[None, :]) == same_label
                home = np.array(part.column(2).to_pylist(), dtype=object)[:, None] == np.array(zones[0].to_pylist(), dtype=object)
                meets = np.zeros_like(fits)
                windows = part.column(8)
                bounds = windows.flatten().to_numpy(zero_copy_only=False).reshape(-1, 2)
                owner = np.repeat(np.arange(part.num_rows), np.diff(windows.offsets.to_numpy()) // 2)
                for who, (least, most) in zip(owner.tolist(), bounds.tolist(), strict=True):
                    meets[who] |= (over[who] >= least) & (under[who] <= most)
                who, zone = np.nonzero(fits & meets & ~home)
                take = pa.array(who)
                yield pa.RecordBatch.from_arrays(
                    [zones[0].take(pa.array(zone)), *(part.column(i).take(take) for i in (4, 6, 7, 8))],
                    names=["block", "vector", "k1", "k2", "windows"],
                )

    return run


def _read(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A block's rows, then the anchors that read it, ``block, kind, vector, ids, k1, k2`` (an anchor's ``ids`` are its windows)
        -> ``k1, k2, score, vec_id``: what of the block is among the ``top`` of any window."""
        block, parts, held = None, [], None
        for name, some in runs(batches):
            if name != block:
                block, parts, held = name, [], None
            kind = some.column(1).to_numpy()
            first = int(np.searchsorted(kind, 1))
            if first:
                parts.append(some.slice(0, first))
            if first == len(kind):
                continue
            if held is None:
                rows = pa.Table.from_batches(parts).combine_chunks()
                ids = rows["ids"].to_pylist()
                held = matrix(rows["vector"].chunk(0)), ids, np.array([key[0] for key in ids])
            vectors, ids, firsts = held
            asks = some.slice(first)
            for at in range(0, asks.num_rows, ANCHORS):
                part = asks.slice(at, ANCHORS)
                out = []
                for scores, windows, k1, k2 in zip(
                    products(matrix(part.column(2)), vectors), *(part.column(i).to_pylist() for i in (3, 4, 5)), strict=True
                ):
                    order = np.lexsort((firsts, -scores))
                    taken = {
                        entry
                        for low, high in zip(windows[::2], windows[1::2], strict=True)
                        for entry in best(scores, ids, order, top, low, high)
                    }
                    out += [(k1, k2, score, key) for score, key, *_ in sorted(taken)]
                columns = zip(*out, strict=True) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.int64()) for c in columns], names=["k1", "k2", "score", "vec_id"]
                )

    return run


def _scores(blocks: DataFrame, zones: DataFrame, anchors: DataFrame, same_label: bool, top: int, name: str) -> DataFrame:
    """``k1, k2, score, vec_id``: of all blocks whose zones meet a window of an anchor, what is among the ``top`` of it.
    ``anchors``: ``size, home, label, vector, k1, k2, windows``, of which ``home`` is a block to leave out."""
    nothing = F.lit(None)
    held = zones.select(
        "page", F.lit(0).alias("kind"), "block", "label", "low", "high",
        nothing.cast("bigint").alias("k1"), nothing.cast("bigint").alias("k2"), nothing.cast("array<bigint>").alias("windows"),
    )
    pages = zones.groupBy("size").agg(F.collect_set("page").alias("pages"))
    asked = anchors.join(pages, "size").select(
        F.explode("pages").alias("page"), F.lit(1).alias("kind"), F.col("home").alias("block"), "label",
        F.col("vector").alias("low"), nothing.cast("array<bigint>").alias("high"), "k1", "k2", "windows",
    )
    paged = held.unionByName(asked).repartition("page").sortWithinPartitions("page", "kind")
    chosen = paged.mapInArrow(
        _choose(same_label), "block string, vector array<bigint>, k1 bigint, k2 bigint, windows array<bigint>"
    )
    asked = chosen.select("block", F.lit(1).alias("kind"), "vector", F.col("windows").alias("ids"), "k1", "k2")
    rows = blocks.select("block", F.lit(0).alias("kind"), "vector", "ids", "k1", "k2")
    both = rows.unionByName(asked).repartition("block").sortWithinPartitions("block", "kind")
    return stored(both.mapInArrow(_read(top), "k1 bigint, k2 bigint, score bigint, vec_id bigint"), name)


def hard_negatives(
    vectors: DataFrame,
    asks: Column,
    label: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    least: int = LEAST,
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``: for each row that ``asks`` holds for and each of
    its ``positives`` best other rows of the same ``label``, the ``negatives`` best rows of other labels with a score from ``least``
    hundredths of the positive's up to all of it.

    ``asks`` and ``label`` (whole numbers) are expressions on ``vectors``. Components count as the floor of 256 times them, scores
    are inner products, equal ones go by the smaller id. Rows without an id or label, and those whose vector is null, empty or
    holds a null or non-finite component, take no part; vectors of different length are not compared. Rows may repeat
    and share ids: an anchor's own row is left out of its positives once, and equal id, label and vector ask once. A positive
    without such negatives gives no row, nor does an empty table. Other columns are not read.
    """
    rows = whole(vectors, id_col, vec_col, label.cast("bigint").alias("label"), asks.alias("_asks")).filter("label IS NOT NULL")
    # The label is part of the key: equal vectors of two labels are two candidates.
    rows = rows.withColumns({"k1": F.xxhash64("vector", "label"), "k2": F.xxhash64(F.lit(2), "vector", "label")})
    asking = rows.filter("_asks").select("vec_id", "k1", "k2", "label")
    taken = stored(classes(rows.drop("_asks"), max(positives + 1, negatives), asking, "label"), "zone-classes")
    curves = {size: Curve(some) for size, some in sample(taken).items()}
    placed = stored(
        taken.mapInArrow(
            _curve(curves),
            "k1 bigint, k2 bigint, label bigint, vector array<bigint>, ids array<bigint>, asks boolean, size int, place bigint",
        ),
        "zone-places",
    )
    order = ["size", "label", "place", "k1", "k2"]
    sorted_ = placed.repartitionByRange(*order).sortWithinPartitions(*order)
    cut = sorted_.select("size", "label", "k1", "k2", "vector", "ids", "asks").mapInArrow(_cut(positives + 1, block), _ROWS)
    blocks = stored(cut, "zone-blocks")
    maps = blocks.filter("low IS NOT NULL").select("size", "block", "label", "low", "high")
    # Pages of zone maps of one size: about ``ZONES`` in each, however many there are.
    pages = -(-maps.count() // ZONES) or 1
    zones = stored(
        maps.withColumn("page", F.concat_ws("-", "size", F.pmod(F.xxhash64("block"), F.lit(pages)))), "zone-maps"
    )
    homes = blocks.filter("asks").select("size", F.col("block").alias("home"), "label", "vector", "k1", "k2", "found")
    floor = F.when(F.size("found") > positives, F.array_min(F.transform("found", lambda f: f["score"])))
    open_ = F.array(F.coalesce(floor, F.lit(LOWEST)), F.lit(HIGHEST))
    near = _scores(blocks, zones, homes.withColumn("windows", open_), True, positives + 1, "zone-positives")
    own = homes.select("k1", "k2", F.inline("found"))
    order = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id")
    best_ = own.unionByName(near.withColumn("same", F.lit(False))).withColumn("_place", F.row_number().over(order))
    ranked = without_own(best_.filter(F.col("_place") <= positives + 1), asking, positives)
    pairs = ranked.select(
        "query_id", "k1", "k2", F.col("rank").alias("nth"), F.col("vec_id").alias("positive_id"), F.col("score").alias("high")
    )
    # Nothing is between four fifths and all of a score below zero.
    pairs = stored(pairs.filter("high >= 0").withColumn("low", F.expr(f"(high * {least} + 99) div 100")), "zone-pairs")
    windows = pairs.groupBy("k1", "k2").agg(F.collect_set(F.struct("low", "high")).alias("w"))
    anchors = homes.join(windows, ["k1", "k2"])
    flat = F.flatten(F.transform("w", lambda w: F.array(w["low"], w["high"])))
    found = _scores(blocks, zones, anchors.withColumn("windows", flat), False, negatives, "zone-negatives")
    met = pairs.join(found, ["k1", "k2"]).filter("score BETWEEN low AND high")
    order = Window.partitionBy("query_id", "k1", "k2", "nth").orderBy(F.desc("score"), "vec_id")
    met = met.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= negatives)
    return met.select(
        F.col("query_id").alias("anchor_id"), "positive_id", "rank", F.col("vec_id").alias("negative_id"),
        F.col("high").alias("positive_score"), F.col("score").alias("negative_score"),
    )
