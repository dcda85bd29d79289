"""Exact search for the largest inner products in an M-tree, best node first.

The metric is the Euclidean distance ``d``; as ``2 * (q . x) = |q|**2 + |x|**2 - d(q, x)**2``, a node whose vectors
are no longer than ``top`` and no nearer to the query than ``lo`` holds no score above
``(|q|**2 + top**2 - lo**2) / 2``. ``lo`` is the distance to the node's routing object less its covering radius,
or, before that distance is worked out, what the triangle inequality leaves of the stored distance between
the routing object and its parent's: a node or vector that this rules out costs no distance at all.

The tree's first level are ``CELLS`` routing objects from a bounded sample, which every task knows. Vectors are
sorted by cell and distance to its object and cut into chunks; each chunk is a subtree, made and
searched by one task: nodes of ``FAN`` children, pages of at most ``PAGE`` vectors, all of them rows of one table.

A block of queries goes through a subtree together, each for itself. A query is searched in its own chunk first, where the vectors like it are. The score that it then has
to beat goes with it to those chunks that may hold better ones, by the bound above on their distances to
the cell's object. Scores are whole numbers, compared exactly; equal ones by the smaller id.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from moodtide.llm.common import stored
from moodtide.llm.vector_rows import classes, matrix, products, runs, sample, whole, without_own

TOP = 5
CELLS = 32
CHUNK = 1 << 15
PAGE = 256
FAN = 8
# Queries that go through a subtree together.
BLOCK = 256
HIGHEST = (1 << 63) - 1
# Kinds of rows of a chunk, in the order in which a task needs them.
NODE, ENTRY, QUERY = 0, 1, 2


def spread(rows: np.ndarray, many: int) -> np.ndarray:
    """So many different rows, each the farthest from those before; fewer if no more differ."""
    picked = [0]
    far = _squares(rows, rows[:1])[:, 0]
    while len(picked) < min(many, len(rows)):
        at = int(far.argmax())
        if far[at] <= 0:
            break
        picked.append(at)
        far = np.minimum(far, _squares(rows, rows[at : at + 1])[:, 0])
    return np.array(picked)


def _squares(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Squared distances; exact as long as they are below 2**53."""
    x, y = a.astype(np.float64), b.astype(np.float64)
    return np.maximum((x * x).sum(1)[:, None] + (y * y).sum(1)[None, :] - 2 * (x @ y.T), 0)


def bound(own: float, top: float, lo: np.ndarray | float) -> np.ndarray | float:
    """No score of whole numbers is above this: half a unit and a billionth allow for rounding."""
    return np.floor((own + top - lo * lo) / 2 + 0.5 + 1e-9 * (own + top))


def _place(objects: dict[int, np.ndarray]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Adds the nearest routing object, and how far it is, squared."""
        for batch in batches:
            column = batch.column(batch.schema.get_field_index("vector"))
            sizes = column.value_lengths().to_numpy()
            cell, square = np.zeros(len(sizes), dtype=np.int32), np.zeros(len(sizes))
            for size in np.unique(sizes):
                rows = np.flatnonzero(sizes == size)
                squares = _squares(matrix(column.take(pa.array(rows))), objects.get(int(size), np.zeros((1, size))))
                cell[rows], square[rows] = squares.argmin(1), squares.min(1)
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(sizes, pa.int32()), pa.array(cell), pa.array(np.sqrt(square))],
                names=[*batch.schema.names, "size", "cell", "from_object"],
            )

    return run


class Tree:
    """A subtree: nodes by number, the root first, and the vectors of its leaves in a row each."""

    def __init__(self, vectors: np.ndarray, ids: list[list[int]]) -> None:
        self.vectors, self.ids = vectors, ids
        self.squares = (vectors.astype(np.float64) ** 2).sum(1)
        self.center: list[np.ndarray] = []
        self.radius: list[float] = []
        self.apart: list[float] = []
        self.top: list[float] = []
        self.least: list[int] = []
        self.children: list[list[int]] = []
        self.rows: list[np.ndarray] = []
        self.leaf = np.zeros(len(vectors), dtype=np.int32)
        self.near = np.zeros(len(vectors))

    @staticmethod
    def made(vectors: np.ndarray, ids: list[list[int]]) -> Tree:
        tree = Tree(vectors, ids)
        middle = np.rint(vectors.mean(0)).astype(np.int64)
        waiting = [(np.arange(len(vectors)), middle, -1, 0.0)]
        while waiting:
            rows, center, parent, apart = waiting.pop()
            squares = _squares(vectors[rows], center[None])[:, 0]
            node = tree._add(center, float(np.sqrt(squares.max())), apart, rows, parent)
            if len(rows) <= PAGE:
                tree.leaf[rows], tree.near[rows], tree.rows[node] = node, np.sqrt(squares), rows
                continue
            # Classes differ, so that every object is nearest to itself alone and no part is all rows.
            objects = vectors[rows[spread(vectors[rows], FAN)]]
            nearest = _squares(vectors[rows], objects).argmin(1)
            for i, chosen in enumerate(objects):
                part = rows[nearest == i]
                waiting.append((part, chosen, node, float(np.sqrt(_squares(chosen[None], center[None])[0, 0]))))
        return tree

    def _add(self, center, radius: float, apart: float, rows: np.ndarray, parent: int) -> int:
        self.center.append(center)
        self.radius.append(radius)
        self.apart.append(apart)
        self.top.append(float(self.squares[rows].max()))
        self.least.append(min(self.ids[row][0] for row in rows.tolist()))
        self.children.append([])
        self.rows.append(np.zeros(0, dtype=np.int64))
        if parent >= 0:
            self.children[parent].append(len(self.center) - 1)
        return len(self.center) - 1

    def ready(self) -> Tree:
        self.reach, self.parted = np.array(self.radius), np.array(self.apart)
        self.tops, self.lowest = np.array(self.top), np.array(self.least)
        self.kids = [np.array(some, dtype=np.int64) for some in self.children]
        self.firsts = np.array([some[0] for some in self.ids], dtype=np.int64)
        return self

    def search(
        self, queries: np.ndarray, top: int, floors: list[list[int] | None], same: np.ndarray | None = None
    ) -> list[list[tuple[int, int, bool]]]:
        """For each query the ``top`` best ``score, id``, and whether of its row in ``same``, that beat its floor; in no order.

        A block of queries goes through the tree together: the node that promises any of them the most is
        next, and only those take part that it still promises something to.
        """
        wide = queries.astype(np.float64)
        own = (wide * wide).sum(1)
        # The score and id to beat: those of the floor, later those of the last of the best.
        score = np.array([floor[0] if floor else -np.inf for floor in floors])
        last = np.array([floor[1] if floor else HIGHEST for floor in floors], dtype=np.int64)
        best: list[list[tuple[int, int, bool]]] = [[] for _ in floors]  # score, -id

        def open_(limit: np.ndarray, who: np.ndarray, node: int) -> np.ndarray:
            return (limit > score[who]) | ((limit == score[who]) & (self.lowest[node] < last[who]))

        queue = [(-np.inf, 0)]
        held = {0: (np.arange(len(wide)), np.full(len(wide), np.inf))}
        while queue:
            _, node = heapq.heappop(queue)
            who, limit = held.pop(node)
            who = who[open_(limit, who, node)]
            away = np.sqrt(_squares(wide[who], self.center[node][None])[:, 0])
            limit = bound(own[who], self.tops[node], np.maximum(0, away - self.reach[node]))
            some = open_(limit, who, node)
            who, away = who[some], away[some]
            if not len(who):
                continue
            kids = self.kids[node]
            if len(kids):
                # Before any distance to a child: by its stored distance to this node's object.
                lo = np.maximum(np.abs(away[:, None] - self.parted[kids]) - self.reach[kids], 0)
                for kid, limit in zip(kids.tolist(), bound(own[who, None], self.tops[kids], lo).T, strict=True):
                    some = open_(limit, who, kid)
                    if some.any():
                        held[kid] = who[some], limit[some]
                        heapq.heappush(queue, (-float(limit[some].max()), kid))
                continue
            self._visit(self.rows[node], wide, own, who, away, score, last, best, top, floors, same)
        return [[(value, -key, own_row) for value, key, own_row in some] for some in best]

    def _visit(self, rows, wide, own, who, away, score, last, best, top, floors, same) -> None:
        """Compare queries with a page, except where its vectors' stored distances rule it out."""
        limit = bound(own[who, None], self.squares[rows], np.abs(away[:, None] - self.near[rows]))
        near = limit >= score[who, None]
        asked, there = near.any(1), near.any(0)
        who, rows, near = who[asked], rows[there], near[asked][:, there]
        if not len(who):
            return
        scores = products(self.vectors[rows], wide[who].astype(np.int64)).T
        near &= (scores > score[who, None]) | ((scores == score[who, None]) & (self.firsts[rows] < last[who, None]))
        if len(rows) > top:
            near &= scores >= np.partition(scores, len(rows) - top, axis=1)[:, len(rows) - top, None]
        at, row = np.nonzero(near)
        order = np.lexsort((self.firsts[rows[row]], -scores[at, row], at))
        for i, value, row_ in zip(at[order].tolist(), scores[at, row][order].tolist(), rows[row[order]].tolist(), strict=True):
            query = int(who[i])
            heap, floor = best[query], floors[query]
            for key in self.ids[row_]:
                entry = (value, -key, same is not None and row_ == same[query])
                if floor and entry[:2] <= (floor[0], -floor[1]):
                    break
                if len(heap) < top:
                    heapq.heappush(heap, entry)
                elif entry[:2] > heap[0][:2]:
                    heapq.heapreplace(heap, entry)
                else:
                    break
            if len(heap) == top:
                score[query], last[query] = heap[0][0], -heap[0][1]


_FOUND = "array<struct<score: bigint, vec_id: bigint, same: boolean>>"
_NODES = (
    "size int, cell int, chunk string, kind int, node int, parent int, vector array<bigint>, radius double, apart double, "
    f"top double, low double, high double, least bigint, ids array<bigint>, k1 bigint, k2 bigint, away array<double>, found {_FOUND}"
)
_NAMES = "size cell chunk kind node parent vector radius apart top low high least ids k1 k2 away found".split()
_LISTS = pa.list_(pa.int64())
_FOUND_TYPE = pa.list_(pa.struct([("score", pa.int64()), ("vec_id", pa.int64()), ("same", pa.bool_())]))


def _build(objects: dict[int, np.ndarray], top: int, most: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows ``size, cell, from_object, k1, k2, vector, ids, asks`` in order -> the rows of their subtrees."""
        number, held, count, key = 0, [], 0, None

        def done() -> pa.RecordBatch:
            rows = pa.Table.from_batches(held).combine_chunks().to_batches()[0]
            return subtree(rows, key, f"{TaskContext.get().partitionId()}-{number}")

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

    def subtree(rows: pa.RecordBatch, key: tuple[int, int], chunk: str) -> pa.RecordBatch:
        size, cell = key
        from_object, k1, k2 = (rows.column(i).to_numpy() for i in (2, 3, 4))
        vectors, ids = matrix(rows.column(5)), rows.column(6).to_pylist()
        asks = np.flatnonzero(rows.column(7).to_numpy(zero_copy_only=False))
        tree = Tree.made(vectors, ids).ready()
        parents = np.full(len(tree.center), -1)
        for node, kids in enumerate(tree.kids):
            parents[kids] = node
        nodes, n = len(tree.center), len(tree.center) + len(vectors)
        away, found = [None] * n, [None] * n
        if len(asks):
            far = np.sqrt(_squares(vectors[asks], objects.get(size, np.zeros((1, size)))))
            for at in range(0, len(asks), BLOCK):
                some = asks[at : at + BLOCK]
                results = tree.search(vectors[some], top, [None] * len(some), some)
                for row, distances, best in zip(some.tolist(), far[at : at + BLOCK], results, strict=True):
                    away[nodes + row] = distances.tolist()
                    found[nodes + row] = [{"score": s, "vec_id": i, "same": same} for s, i, same in best]
        none, zeros = [None] * nodes, np.zeros(nodes)
        values = np.concatenate([np.array(tree.center, dtype=np.int64).reshape(nodes, -1), vectors])
        lists = pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * size, pa.int32()), pa.array(values.ravel()))
        low, high = float(from_object.min()), float(from_object.max())
        return pa.RecordBatch.from_arrays(
            [
                pa.array([size] * n, pa.int32()), pa.array([cell] * n, pa.int32()), pa.array([chunk] * n),
                pa.array([NODE] * nodes + [ENTRY] * len(vectors), pa.int32()),
                pa.array(np.concatenate([np.arange(nodes), tree.leaf]), pa.int32()),
                pa.array(np.concatenate([parents, tree.leaf]), pa.int32()), lists,
                pa.array(np.concatenate([tree.reach, np.zeros(len(vectors))])),
                pa.array(np.concatenate([tree.parted, tree.near])),
                pa.array(np.concatenate([tree.tops, tree.squares])),
                pa.array(np.concatenate([zeros + low, from_object])), pa.array(np.concatenate([zeros + high, from_object])),
                pa.array(np.concatenate([tree.lowest, tree.firsts])), pa.array(none + ids, _LISTS),
                pa.array(none + k1.tolist(), pa.int64()), pa.array(none + k2.tolist(), pa.int64()),
                pa.array(away, pa.list_(pa.float64())), pa.array(found, _FOUND_TYPE),
            ],
            names=_NAMES,
        )

    return run


_WANTED = "chunk kind node parent vector radius apart top least ids k1 k2".split()


def loaded(rows: pa.Table) -> Tree:
    """The subtree that a chunk's rows hold."""
    kind = rows["kind"].to_numpy()
    nodes, entries = rows.filter(pa.array(kind == NODE)).combine_chunks(), rows.filter(pa.array(kind == ENTRY)).combine_chunks()
    tree = Tree(matrix(entries["vector"].chunk(0)), entries["ids"].to_pylist())
    order = np.argsort(nodes["node"].to_numpy())
    tree.center = list(matrix(nodes["vector"].chunk(0))[order])
    tree.radius, tree.apart, tree.top, tree.least = (
        nodes[name].to_numpy()[order].tolist() for name in ("radius", "apart", "top", "least")
    )
    tree.children = [[] for _ in order]
    for node, parent in enumerate(nodes["parent"].to_numpy()[order].tolist()):
        if parent >= 0:
            tree.children[parent].append(node)
    leaf = entries["node"].to_numpy()
    by = np.argsort(leaf, kind="stable")
    ends = np.searchsorted(leaf[by], np.arange(len(order) + 1))
    tree.rows = [by[ends[i] : ends[i + 1]] for i in range(len(order))]
    tree.near = entries["apart"].to_numpy()
    return tree.ready()


def _search(top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """A chunk's nodes and vectors, then its queries, as many as there are -> ``k1, k2, score, vec_id``.
        A query's ``ids`` are the score to beat and the id of that, or null."""
        chunk, parts, tree = None, [], None
        for name, some in runs(batches):
            if name != chunk:
                chunk, parts, tree = name, [], None
            kind = some.column(1).to_numpy()
            first = int(np.searchsorted(kind, QUERY))
            if first:
                parts.append(some.slice(0, first))
            if first == len(kind):
                continue
            tree = tree or loaded(pa.Table.from_batches(parts))
            for at in range(first, some.num_rows, BLOCK):
                asks = some.slice(at, BLOCK)
                floors, k1, k2 = (asks.column(i).to_pylist() for i in (9, 10, 11))
                results = tree.search(matrix(asks.column(4)), top, floors)
                out = [(a, b, s, i) for a, b, best in zip(k1, k2, results, strict=True) for s, i, _ in best]
                columns = zip(*out, strict=True) if out else [[]] * 4
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(c), pa.int64()) for c in columns], names=["k1", "k2", "score", "vec_id"]
                )

    return run


def _best(found: DataFrame, top: int) -> DataFrame:
    order = Window.partitionBy("k1", "k2").orderBy(F.desc("score"), "vec_id")
    return found.withColumn("_place", F.row_number().over(order)).filter(F.col("_place") <= top).drop("_place")


def nearest(
    vectors: DataFrame,
    asks: Column,
    id_col: str = "vec_id",
    vec_col: str = "embedding",
    top: int = TOP,
    chunk: int = CHUNK,
) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each row that ``asks``, a condition on ``vectors``, holds for, the
    ``top`` other rows with the largest inner products, equal ones by the smaller id.

    Components count as the floor of 256 times them. Rows without an id, and those whose vector is null, empty or
    holds a null or non-finite component, take no part; vectors of different length are not compared. Rows may repeat
    and share ids: a query's own row is left out once, and equal id and vector ask once. Inner products and squared
    lengths have to stay below 2**53. An empty table gives no rows; other columns are not read.
    """
    rows = whole(vectors, id_col, vec_col, asks.alias("_asks"))
    asking = rows.filter("_asks").select("vec_id", "k1", "k2")
    # One more than asked for: the query's own row is among them.
    taken = stored(classes(rows.drop("_asks"), top + 1, asking), "tree-classes")
    objects = {size: some[spread(some, CELLS)] for size, some in sample(taken).items()}
    placed = taken.mapInArrow(
        _place(objects),
        "k1 bigint, k2 bigint, vector array<bigint>, ids array<bigint>, asks boolean, size int, cell int, from_object double",
    )
    order = ["size", "cell", "from_object", "k1", "k2"]
    # Ranges of all of these, so that no cell is one task's however many vectors it has.
    sorted_ = stored(placed, "tree-placed").repartitionByRange(*order).sortWithinPartitions(*order)
    tree = stored(
        sorted_.select(*order, "vector", "ids", "asks").mapInArrow(_build(objects, top + 1, chunk), _NODES), "tree-nodes"
    )
    homes = tree.filter("kind = 1 AND found IS NOT NULL").select(
        "size", F.col("chunk").alias("home"), "vector", F.col("top").alias("own"), "k1", "k2", "away",
        F.when(F.size("found") > top, F.element_at(F.expr("sort_array(transform(found, f -> struct(f.score AS s, -f.vec_id AS i)))"), 1))
        .alias("floor"),
    )
    chunks = tree.filter("kind = 0 AND parent < 0").select("size", "cell", "chunk", "top", "low", "high", "least")
    limit = F.expr("floor((own + top - lo * lo) / 2 + 0.5 + 1e-9 * (own + top))")
    asked = (
        homes.select("*", F.posexplode("away").alias("cell", "from_query")).join(chunks, ["size", "cell"])
        .withColumn("lo", F.greatest(F.lit(0.0), F.col("from_query") - F.col("high"), F.col("low") - F.col("from_query")))
        .withColumn("limit", limit)
        .filter("chunk != home AND (floor IS NULL OR limit > floor.s OR limit = floor.s AND least < -floor.i)")
    )
    to_beat = F.when(F.col("floor").isNotNull(), F.array(F.col("floor.s"), -F.col("floor.i")))
    queries = asked.select(
        "chunk", F.lit(QUERY).alias("kind"), F.lit(0).alias("node"), F.lit(0).alias("parent"), "vector",
        *[F.lit(None).cast("double").alias(name) for name in ("radius", "apart", "top")],
        F.lit(None).cast("bigint").alias("least"), to_beat.alias("ids"), "k1", "k2",
    )
    both = tree.select(*_WANTED).unionByName(queries).repartition("chunk").sortWithinPartitions("chunk", "kind", "node")
    away = stored(both.mapInArrow(_search(top + 1), "k1 bigint, k2 bigint, score bigint, vec_id bigint"), "tree-found")
    own = tree.filter("kind = 1 AND found IS NOT NULL").select("k1", "k2", F.inline("found"))
    best = _best(own.unionByName(away.withColumn("same", F.lit(False))), top + 1)
    return without_own(best, asking, top).select("query_id", "rank", "vec_id", "score")
