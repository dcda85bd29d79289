"""Near-duplicate texts by 64-bit fingerprints, compared many at a time in bit-sliced form.

A fingerprint's bit is set where over half of the text's 3-word shingles have it set in their
hash. Two texts are linked when their fingerprints differ in few bits.

Fingerprints that differ in at most ``RADIUS`` bits agree in at least one of the keys made from
some of their blocks, so each goes to one cell per key. In a cell, 64 fingerprints lie side by
side as 64 words, one per bit: a word holds that bit of all 64. A query is compared to them with
one exclusive-or per bit, whose outcome carry-save counters add up for the 64 at once; blocks in
which every count has passed the radius are left.

Equal texts share a fingerprint and are compared once. A full cell is cut into chunks and each
pair of chunks is a cell of its own, so no task holds more than two chunks of one key. A task gives
the links of a spanning forest of what it found, never all pairs.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from moodtide.llm.common import fresh, stored
from moodtide.llm.graph import components

RADIUS = 3
SEED = 42
CHUNK = 2048
# Fingerprints that a task compares at a time, beyond a started cell; pairs of a query and a
# block of 64 that it holds at a time; hashes whose bits it counts at a time.
AT_ONCE = 1 << 16
WORK = 1 << 18
HASHES = 1 << 16
ALL = np.uint64(0xFFFFFFFFFFFFFFFF)


def fingerprint(text: str | None) -> int:
    """The fingerprint of one text, as a signed 64-bit number; zero for one without words."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    joined, hashed = b" ".join(words), xxhash.xxh64_intdigest
    if len(words) <= 3:
        hashes = np.array([hashed(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-3] + 1))
        hashes = np.fromiter(
            (hashed(joined[a:b], SEED) for a, b in zip(starts.tolist(), ends[2:].tolist(), strict=True)),
            np.uint64,
            len(words) - 2,
        )
    counts = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), HASHES):
        part = hashes[at : at + HASHES].astype("<u8").view(np.uint8).reshape(-1, 8)
        counts += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int64)
    bits = np.packbits(counts * 2 > len(hashes), bitorder="little")
    return int(bits.view("<i8")[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, fp``: one row per document. ASCII letters are lowered, other ones stay."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(text) for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([batch.column(0), pa.array(prints, pa.int64())], names=["doc_id", "fp"])

    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return narrow.mapInArrow(run, "doc_id bigint, fp bigint")


def layout(n: int) -> tuple[int, int]:
    """(blocks, blocks in a key) for ``n`` fingerprints: longer keys, and more of them, once short
    ones would put many unrelated fingerprints into a cell. Any gives the same links."""
    if n <= 1 << 23:
        return RADIUS + 1, 1
    return (RADIUS + 2, 2) if n <= 1 << 31 else (RADIUS + 3, 3)


def keys_of(fp: Column, blocks: int, chosen: int) -> Column:
    """An array of (key number, key). Of ``blocks`` blocks at most ``RADIUS`` differ in a link, so
    some choice of ``blocks - RADIUS`` of them is equal."""
    edges = [round(64 * i / blocks) for i in range(blocks + 1)]
    made = []
    for number, picked in enumerate(combinations(range(blocks), chosen)):
        key = F.lit(0).cast("bigint")
        for block in picked:
            width = edges[block + 1] - edges[block]
            part = F.shiftrightunsigned(fp, edges[block]).bitwiseAND(F.lit((1 << width) - 1).cast("bigint"))
            key = F.shiftleft(key, width).bitwiseOR(part)
        made.append(F.struct(F.lit(number).alias("number"), key.alias("key")))
    return F.array(*made)


def planes_of(prints: np.ndarray) -> np.ndarray:
    """``(64, blocks)`` words: bit ``lane`` of word ``(p, k)`` is bit ``p`` of fingerprint
    ``64 * k + lane``."""
    padded = np.zeros(-(-len(prints) // 64) * 64, dtype="<u8")
    padded[: len(prints)] = prints
    bits = np.unpackbits(padded.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
    turned = bits.reshape(-1, 64, 64).transpose(0, 2, 1)
    return np.packbits(turned, axis=2, bitorder="little").reshape(-1, 64 * 8).view("<u8").T.copy()


def within(planes: np.ndarray, query: np.ndarray, block: np.ndarray, lanes: np.ndarray, radius: int) -> tuple:
    """Of pairs of a query fingerprint and a block, with the lanes that count: the index of every
    pair with a match, and its matching lanes.

    The counters start so far below their overflow that it comes at ``radius + 1`` differences.
    """
    planes_of_count = max(1, radius.bit_length())
    start = (1 << planes_of_count) - (radius + 1)
    count = [np.full(len(query), ALL if start >> i & 1 else 0, dtype=np.uint64) for i in range(planes_of_count)]
    index, far = np.arange(len(query)), ~lanes
    for bit in range(64):
        carry = planes[bit, block] ^ (np.uint64(0) - (query >> np.uint64(bit) & np.uint64(1)))
        for i, plane in enumerate(count):
            count[i], carry = plane ^ carry, plane & carry
        far = far | carry
        if bit % 8 == 7:
            near = far != ALL
            if not near.all():
                index, query, block, far = index[near], query[near], block[near], far[near]
                count = [plane[near] for plane in count]
    return index, ~far


def forest(prints: np.ndarray, first: np.ndarray, last: np.ndarray, radius: int = RADIUS) -> np.ndarray:
    """For each fingerprint the lowest index it is joined to by links between ``i`` and any of
    ``first[i]`` to ``last[i]`` (exclusive)."""
    label = np.arange(len(prints))
    planes = planes_of(prints)
    asks = np.flatnonzero(first < last)
    spans = (last[asks] - 1) // 64 - first[asks] // 64 + 1
    ends = np.cumsum(spans)
    at = 0
    while at < len(asks):
        upto = max(at + 1, int(np.searchsorted(ends, (ends[at - 1] if at else 0) + WORK, "right")))
        rows, times = asks[at:upto], spans[at:upto]
        who = np.repeat(rows, times)
        block = np.arange(len(who)) - np.repeat(np.cumsum(times) - times, times) + np.repeat(first[rows] // 64, times)
        low = np.clip(first[who] - block * 64, 0, 64).astype(np.uint64)
        high = np.clip(last[who] - block * 64, 0, 64).astype(np.uint64)
        lanes = _below(high) & ~_below(low)
        index, found = within(planes, prints[who], block, lanes, radius)
        for part in range(0, len(index), WORK // 16):
            some, hits = index[part : part + WORK // 16], found[part : part + WORK // 16]
            pair, lane = np.nonzero(np.unpackbits(hits.astype("<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little"))
            _hook(label, who[some[pair]], block[some[pair]] * 64 + lane)
        at = upto
    return label


def _below(n: np.ndarray) -> np.ndarray:
    """Words with the lowest ``n`` bits set, ``n`` from 0 to 64."""
    return np.where(n >= 64, ALL, (np.uint64(1) << (n & np.uint64(63))) - np.uint64(1))


def _hook(label: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Join the trees of each pair under their lowest root; every label is a root after it."""
    while len(a):
        x, y = label[a], label[b]
        apart = x != y
        a, b, x, y = a[apart], b[apart], x[apart], y[apart]
        np.minimum.at(label, np.maximum(x, y), np.minimum(x, y))
        while not np.array_equal(label, jumped := label[label]):
            label[:] = jumped


def _compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows ``number, key, low, high, chunk, fp`` sorted by cell and chunk -> links ``a, b``."""

    def links(rows: np.ndarray) -> pa.RecordBatch:
        # rows: columns cell start marker, side (chunk is the cell's lower one), same, fp
        n = len(rows)
        cells = np.flatnonzero(rows[:, 0])
        cell = np.cumsum(rows[:, 0]) - 1
        ends = np.append(cells[1:], n)[cell]
        index = np.arange(n)
        # Lower chunks come first, so that the other side starts after as many rows as they are.
        lower = np.bincount(cell, weights=rows[:, 1], minlength=len(cells)).astype(np.int64)[cell] + cells[cell]
        first = np.where(rows[:, 2] == 1, index + 1, np.where(rows[:, 1] == 1, lower, n))
        label = forest(rows[:, 3].astype(np.uint64), first, ends)
        moved = np.flatnonzero(label != index)
        fps = rows[:, 3]
        return pa.RecordBatch.from_arrays([pa.array(fps[moved]), pa.array(fps[label[moved]])], names=["a", "b"])

    held: list[np.ndarray] = []
    size, previous = 0, None
    for batch in batches:
        if not batch.num_rows:
            continue
        number, key, low, high, chunk, fp = (batch.column(i).to_numpy() for i in range(6))
        cell = np.stack([number, key, low, high], axis=1)
        starts = np.ones(len(cell), dtype=np.int64)
        starts[1:] = (cell[1:] != cell[:-1]).any(axis=1)
        if previous is not None:
            starts[0] = (cell[0] != previous).any()
        previous = cell[-1]
        held.append(np.stack([starts, chunk == low, low == high, fp], axis=1).astype(np.int64))
        size += len(cell)
        if size >= AT_ONCE:
            rows = np.concatenate(held)
            last = int(np.flatnonzero(rows[:, 0])[-1])
            if last:
                yield links(rows[:last])
            held, size = [rows[last:]], len(rows) - last
    if size:
        yield links(np.concatenate(held))


def links_within(prints: DataFrame, chunk: int = CHUNK, blocks: tuple[int, int] | None = None) -> DataFrame:
    """``a, b`` links that join any distinct fingerprints ``fp`` as all links within the radius do."""
    keyed = prints.select(F.inline(keys_of(F.col("fp"), *(blocks or layout(prints.count())))), "fp")
    full = keyed.groupBy("number", "key").agg(F.count("*").alias("n")).filter(F.col("n") > chunk)
    # A small written table: Spark broadcasts it if it is under its limit, else joins by shuffle.
    cuts = stored(full.select("number", "key", F.ceil(F.col("n") / chunk).cast("int").alias("cuts")), "full-cells")
    cut = keyed.join(cuts, ["number", "key"], "left").withColumn("cuts", F.coalesce("cuts", F.lit(1)))
    own = cut.withColumn("chunk", F.pmod(F.xxhash64("fp", F.lit("chunk")), F.col("cuts")).cast("int"))
    other = F.explode(F.sequence(F.lit(0), F.col("cuts") - 1)).alias("other")
    dealt = own.select("number", "key", "chunk", "fp", other).select(
        "number", "key", F.least("chunk", "other").alias("low"), F.greatest("chunk", "other").alias("high"), "chunk", "fp"
    )
    cells = dealt.repartition("number", "key", "low", "high")
    cells = cells.sortWithinPartitions("number", "key", "low", "high", "chunk")
    longs = cells.select(*[F.col(c).cast("bigint").alias(c) for c in cells.columns])
    return longs.mapInArrow(_compare, "a bigint, b bigint")


def components_of(prints: DataFrame, chunk: int = CHUNK) -> DataFrame:
    """``known, component_id`` of every fingerprint, from ``doc_id, fp``: the smallest id of all
    documents that its links reach."""
    nodes = stored(prints.groupBy("fp").agg(F.min("doc_id").alias("doc_id")), "print-nodes")
    roots = stored(components(links_within(nodes.select("fp"), chunk)), "print-roots")
    joined = nodes.join(roots, nodes.fp == roots.node).groupBy("root").agg(F.min("doc_id").alias("component_id"))
    named = roots.join(joined, "root").select(F.col("node").alias("linked"), "component_id")
    known = nodes.join(named, F.col("fp") == F.col("linked"), "left")
    return stored(
        known.select(
            F.col("fp").alias("known"),
            F.when(F.col("linked").isNull(), F.col("doc_id")).otherwise(F.col("component_id")).alias("component_id"),
        ),
        "print-components",
    )


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``doc_id, fingerprint, component_id``: one row per row of ``docs``.

    Null, empty and blank texts have fingerprint zero and link like any other. Components join
    fingerprints, not ids, so rows may repeat and share an id; a component's id is its smallest
    that is not null, or null if it has none. An empty table gives no rows; other columns are not read.
    """
    prints = stored(fingerprints(docs, id_col, text_col), "prints")
    return prints.join(components_of(prints, chunk), F.col("fp") == F.col("known"), "left").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def without_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", chunk: int = CHUNK) -> DataFrame:
    """``docs`` with one document of each component, the one whose id names it; rows that share that
    id stay together, and components without any id stay whole. Columns are unchanged.

    Only ids travel: those that go are joined to the documents by id, which Spark splits by size.
    """
    prints = stored(fingerprints(docs, id_col, text_col), "prints")
    judged = prints.join(components_of(prints, chunk), F.col("fp") == F.col("known"), "left")
    # An id is kept if any of its rows names a component, so that ids are kept or dropped whole.
    lost = judged.groupBy("doc_id").agg(F.max((F.col("doc_id") == F.col("component_id")).cast("int")).alias("kept"))
    lost = stored(lost.filter("kept = 0").select(F.col("doc_id").alias("_lost")), "prints-lost")
    (row,) = fresh(docs.columns, "_row")
    whole = docs.select(F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(row))
    kept = whole.join(lost, F.col(row)[id_col].cast("bigint") == F.col("_lost"), "left_anti")
    return kept.select(*[F.col(row)[c].alias(c) for c in docs.columns])
