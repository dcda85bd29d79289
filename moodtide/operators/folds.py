"""Aggregates of the user's own: initial state, adder, merger, finisher (U4).

Rows are folded where they are read: a task keeps one state per key that it meets, adds each Arrow batch's rows to
these, and gives the states away when it ends or holds too many. Only states are shuffled; they come sorted by
key and are merged one after the other. So no group is ever held whole, and a key with a third of all rows
sends a few states per task. A fold has to give the same in any order and grouping of its rows.
"""

from __future__ import annotations

import sys
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

# Folds go to the executors by themselves; none has to have this package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Keys whose states a task holds before it gives them away.
HELD = 1 << 16
State = tuple


@dataclass(frozen=True)
class Fold:
    """``state`` and ``result`` name and type the fields of both, as DDL. ``add`` takes a state and one array per input
    column with some rows of a key, and gives the next state; ``merge`` takes two states; ``finish`` gives the
    result's fields."""

    state: str
    result: str
    initial: Callable[[], State]
    add: Callable[..., State]
    merge: Callable[[State, State], State]
    finish: Callable[[State], tuple]


def _partial(fold: Fold, keys: int, fields: list[pa.Field], held_keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[tuple, State] = {}
        for batch in batches:
            if not batch.num_rows:
                continue
            # Rows of a key side by side, keys numbered by their first row.
            place: dict[tuple, int] = {}
            number = np.fromiter(
                (place.setdefault(key, len(place)) for key in zip(*(batch.column(i).to_pylist() for i in range(keys)), strict=True)),
                np.int64,
                batch.num_rows,
            )
            order = np.argsort(number, kind="stable")
            ends = np.searchsorted(number[order], np.arange(len(place) + 1))
            columns = [batch.column(i).to_numpy(zero_copy_only=False)[order] for i in range(keys, batch.num_columns)]
            for key, at, end in zip(place, ends[:-1].tolist(), ends[1:].tolist(), strict=True):
                held[key] = fold.add(held[key] if key in held else fold.initial(), *(c[at:end] for c in columns))
            if len(held) >= held_keys:
                yield states(held)
                held = {}
        if held:
            yield states(held)

    def states(held: dict[tuple, State]) -> pa.RecordBatch:
        return _rows([(*key, *state) for key, state in held.items()], fields)

    return run


def _rows(rows: list[tuple], fields: list[pa.Field]) -> pa.RecordBatch:
    columns = [pa.array(list(values), field.type) for values, field in zip(zip(*rows, strict=True), fields, strict=True)]
    return pa.RecordBatch.from_arrays(columns, schema=pa.schema(fields))


def _merged(fold: Fold, keys: int, fields: list[pa.Field], at_once: int = 1 << 12):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """States sorted by key -> results."""
        current, state, out = None, None, []
        for batch in batches:
            for row in zip(*(column.to_pylist() for column in batch.columns), strict=True):
                key, part = row[:keys], row[keys:]
                if key == current:
                    state = fold.merge(state, part)
                    continue
                if current is not None:
                    out.append((*current, *fold.finish(state)))
                current, state = key, part
                if len(out) >= at_once:
                    yield _rows(out, fields)
                    out = []
        if current is not None:
            out.append((*current, *fold.finish(state)))
        if out:
            yield _rows(out, fields)

    return run


def folded(rows: DataFrame, keys: Sequence[str], columns: Sequence[str], fold: Fold, held_keys: int = HELD) -> DataFrame:
    """``keys`` and the fold's result: a row per key. Rows without a key do not count; an empty table gives no rows."""
    present = rows.select(*keys, *columns)
    for key in keys:
        present = present.filter(present[key].isNotNull())
    key_fields = [present.schema[key] for key in keys]
    states = T.StructType([*key_fields, *T._parse_datatype_string(fold.state).fields])
    results = T.StructType([*key_fields, *T._parse_datatype_string(fold.result).fields])
    partial = _partial(fold, len(keys), list(to_arrow_schema(states)), held_keys)
    sent = present.mapInArrow(partial, states).repartition(*keys).sortWithinPartitions(*keys)
    return sent.mapInArrow(_merged(fold, len(keys), list(to_arrow_schema(results))), results)


def decayed_mean(half_life_ms: int) -> Fold:
    """The mean of scores, each worth half as much per ``half_life_ms`` of age. Inputs: score, age in ms."""

    def add(state: State, score: np.ndarray, age: np.ndarray) -> State:
        worth = 0.5 ** (age / half_life_ms)
        return state[0] + float((score * worth).sum()), state[1] + float(worth.sum())

    return Fold(
        "weighted DOUBLE, weights DOUBLE",
        "decayed_score DOUBLE",
        lambda: (0.0, 0.0),
        add,
        lambda a, b: (a[0] + b[0], a[1] + b[1]),
        lambda state: (state[0] / state[1] if state[1] else 0.0,),
    )
