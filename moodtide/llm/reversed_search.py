"""Ranked lexical search with the roles turned round: queries are indexed, documents stream by.

The items' terms make an inverted index, term to items, which is small enough to send to every task.
One pass over the documents counts the terms that the index knows; document frequencies and lengths
come from these counts. A second pass reads only the counts: each document's terms go through the
index, their scores are added up per item, and every task keeps a bounded heap of the best documents
of each item. The heaps are merged in two steps, so that no item's candidates meet in one task first.

An index holds at most ``POSTINGS`` pairs of term and item: more items are dealt over several indexes,
each with passes of its own. Only an item that has more terms by itself makes a larger one.
"""

from __future__ import annotations

import heapq
import math
import re
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from moodtide.llm.common import stored
from moodtide.llm.tokens import ROWS, slices, texts

TOP = 10
# Pairs of term and item that an index holds; documents times items that a task scores at a time.
POSTINGS = 1 << 20
CELLS = 1 << 20
# Parts that an item's candidates are merged in first.
SALTS = 32
# In UTF-8: ASCII digits and letters, and all that is no ASCII.
TERM = re.compile(rb"[0-9a-z\x80-\xff]+")
EXACT = 1 << 53


def terms_of(text: str | None) -> Counter:
    """How often each term comes in a text. Lower-casing bytes changes A to Z alone."""
    found: Counter = Counter()
    for piece in slices((text or "").encode("utf-8", "surrogatepass")):
        found.update(TERM.findall(piece.lower()))
    return found


def weight(documents: int, with_term: int) -> int:
    return math.floor(1000 * math.log((2 * documents + 2) / (2 * with_term + 1)))


def _item_terms(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [sorted(terms_of(text)) for text in batch.column(1).to_pylist()]
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(found, pa.list_(pa.binary()))], names=["item", "terms"]
        )


class Index:
    """Terms by number, and for each the places of the items that hold it."""

    def __init__(self, items: list[tuple[int, list[bytes]]]) -> None:
        self.items = np.array([item for item, _ in items], dtype=np.int64)
        self.terms = {term: i for i, term in enumerate(sorted({bytes(t) for _, terms in items for t in terms}))}
        pairs = np.array(
            [(self.terms[bytes(term)], place) for place, (_, terms) in enumerate(items) for term in terms], dtype=np.int64
        ).reshape(-1, 2)
        pairs = pairs[np.argsort(pairs[:, 0], kind="stable")]
        self.posted = pairs[:, 1].copy()
        self.start = np.searchsorted(pairs[:, 0], np.arange(len(self.terms) + 1))


def _count(index):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``doc_id, text`` -> ``doc_id, n, terms, times``: the length of each text in terms, and the terms
        that the index knows."""
        known = index.value.terms
        for batch in batches:
            for at, some in texts(batch, 1):
                sizes, terms, times, ends = [], [], [], [0]
                for text in some:
                    found = terms_of(text)
                    sizes.append(found.total())
                    for term in found.keys() & known.keys():
                        terms.append(known[term])
                        times.append(found[term])
                    ends.append(len(terms))
                lists = [pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(x, pa.int32())) for x in (terms, times)]
                ids = batch.column(0).slice(at, len(some))
                yield pa.RecordBatch.from_arrays(
                    [ids, pa.array(sizes, pa.int64()), *lists], names=["doc_id", "n", "terms", "times"]
                )

    return run


class Heaps:
    """The best documents of each item, no more than ``top``: the higher score, then the smaller id, then
    any id before none."""

    def __init__(self, items: int, top: int) -> None:
        self.heaps: list[list[tuple[int, int, int]]] = [[] for _ in range(items)]
        self.floor = np.ones(items, dtype=np.int64)
        self.top = top

    def add(self, scores: np.ndarray, ids: list[int | None]) -> None:
        """``scores``: documents by items. What is below an item's floor is never looked at."""
        docs, items = np.nonzero(scores >= self.floor)
        for doc, item, score in zip(docs.tolist(), items.tolist(), scores[docs, items].tolist(), strict=True):
            heap, key = self.heaps[item], ids[doc]
            entry = (score, 0, 0) if key is None else (score, 1, -key)
            if len(heap) < self.top:
                heapq.heappush(heap, entry)
            elif entry > heap[0]:
                heapq.heapreplace(heap, entry)
            if len(heap) == self.top:
                self.floor[item] = heap[0][0]


def _score(index, weights: np.ndarray, documents: int, length: int, top: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """``doc_id, n, terms, times`` -> ``item, doc_id, score``: the best of all documents of the task."""
        held = index.value
        items, start = len(held.items), held.start
        many = start[1:] - start[:-1]
        heaps, rows = Heaps(items, top), max(1, min(ROWS, CELLS // items))
        for batch in batches:
            for at in range(0, batch.num_rows, rows):
                part = batch.slice(at, rows)
                ids, terms, times = part.column(0).to_pylist(), part.column(2), part.column(3)
                doc = np.repeat(np.arange(part.num_rows), np.diff(terms.offsets.to_numpy()))
                term, tf = terms.flatten().to_numpy(), times.flatten().to_numpy().astype(np.int64)
                m = 100 - 90 + 90 * part.column(1).to_numpy() * documents // length
                worth = weights[term] * (1_000_000_000 * tf // (1000 * tf + 8 * m[doc]))
                doc, term, worth = doc[worth > 0], term[worth > 0], worth[worth > 0]
                size = many[term]
                inside = np.arange(int(size.sum())) - np.repeat(np.cumsum(size) - size, size)
                cell = np.repeat(doc * items, size) + held.posted[np.repeat(start[term], size) + inside]
                worth = np.repeat(worth, size)
                if int(worth.max(initial=0)) * len(held.terms) < EXACT:
                    scores = np.bincount(cell, worth, part.num_rows * items).astype(np.int64)
                else:
                    scores = np.zeros(part.num_rows * items, dtype=np.int64)
                    np.add.at(scores, cell, worth)
                heaps.add(scores.reshape(-1, items), ids)
        best = [(item, None if not named else -key, score) for item, heap in enumerate(heaps.heaps) for score, named, key in heap]
        yield pa.RecordBatch.from_arrays(
            [
                pa.array(held.items[[item for item, _, _ in best]] if best else [], pa.int64()),
                pa.array([key for _, key, _ in best], pa.int64()),
                pa.array([score for _, _, score in best], pa.int64()),
            ],
            names=["item", "doc_id", "score"],
        )

    return run


def _dealt(items: DataFrame, most: int) -> list[DataFrame]:
    """``item, terms`` in parts of at most ``most`` terms, or of one item."""
    items = items.filter(F.size("terms") > 0)
    total = items.agg(F.sum(F.size("terms"))).first()[0]
    parts = -(-(total or 0) // most)
    while parts:
        part = F.pmod(F.xxhash64("item"), F.lit(parts)).alias("part")
        sizes = items.groupBy(part).agg(F.sum(F.size("terms")).alias("terms"), F.count("*").alias("items"))
        if not sizes.filter((F.col("terms") > most) & (F.col("items") > 1)).limit(1).count():
            return [items.filter(part == row.part) for row in sizes.select("part").collect()]
        parts *= 2
    return []


def _best(found: DataFrame, top: int, *by) -> DataFrame:
    order = Window.partitionBy(*by).orderBy(F.desc("score"), F.asc_nulls_last("doc_id"))
    return found.withColumn("rank", F.row_number().over(order)).filter(F.col("rank") <= top)


def ranked_documents(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    top: int = TOP,
    postings: int = POSTINGS,
) -> DataFrame:
    """``item_id, rank, doc_id, score``: the ``top`` documents of each row of ``items`` with a score above
    zero, equal scores by ascending id, documents without one last.

    Texts are read whole, however long. Null, empty and term-less texts score nothing and do not
    count as documents; items with such a text give no rows, nor does an empty table. Every row is a
    document or an item of its own: rows that repeat or share an id are ranked each. Other columns are
    not read.
    """
    spark = docs.sparkSession
    named = items.select(F.col(item_col).alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    # Written, so that an item's number stays what it is.
    named = stored(named.withColumn("item", F.monotonically_increasing_id()), "search-items")
    terms = stored(named.select("item", "text").mapInArrow(_item_terms, "item bigint, terms array<binary>"), "search-terms")
    narrow = docs.select(F.col(id_col).cast("bigint").alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    found = spark.createDataFrame([], "item bigint, doc_id bigint, score bigint")
    for part in _dealt(terms, postings):
        index = Index([(row.item, row.terms) for row in part.collect()])
        sent = spark.sparkContext.broadcast(index)
        schema = "doc_id bigint, n bigint, terms array<int>, times array<int>"
        counts = stored(narrow.mapInArrow(_count(sent), schema).filter("n > 0"), "search-counts")
        corpus = counts.agg(F.count("*").alias("documents"), F.sum("n").alias("length")).first()
        if not corpus.documents:
            return found.select(F.lit(None).cast(named.schema["item_id"].dataType).alias("item_id"),
                                F.lit(0).alias("rank"), "doc_id", "score")
        # At most as many rows as the index has terms.
        holding = counts.select(F.explode("terms").alias("term")).groupBy("term").count().collect()
        weights = np.zeros(len(index.terms), dtype=np.int64)
        for row in holding:
            weights[row.term] = weight(corpus.documents, row["count"])
        scored = counts.mapInArrow(
            _score(sent, weights, corpus.documents, corpus.length, top), "item bigint, doc_id bigint, score bigint"
        )
        found = found.unionByName(stored(scored, "search-heaps"))
    fewer = _best(found, top, "item", F.pmod(F.xxhash64("doc_id", "score"), F.lit(SALTS)))
    best = _best(fewer.drop("rank"), top, "item")
    return best.join(named.select("item", "item_id"), "item").select("item_id", "rank", "doc_id", "score")
