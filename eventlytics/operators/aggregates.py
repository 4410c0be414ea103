"""Aggregates that a user defines (U2): zero, add, merge, finish.

The states are any Python values that can be pickled. Each task adds its rows
to one state per key and sends what it has at its end (or, if it meets more
than ``most_keys`` keys, now and then): a key with a third of all rows leaves
a task as one row. These partial states are merged where keys meet, in two
steps, so that a key which every task has is first merged in ``fan`` groups.
A merging task reads its partial states in order of the keys and holds one
state at a time; nobody holds the rows or the states of a key together.

For aggregates that Spark has built in, use these: they stay in the JVM.

Defined cases: rows with a null key are a key of their own; an aggregate must
take nulls in its input columns as it wants; an empty table gives no rows.
``merge`` must be associative and commutative, as rows come in no order.
"""

from __future__ import annotations

import pickle
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass
from typing import Any

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MOST_KEYS = 100_000


@dataclass(frozen=True)
class Aggregate:
    """``add(state, *values)`` takes the values of the input columns of a row;
    ``add`` and ``merge`` return the new state (they may change the first)."""

    zero: Callable[[], Any]
    add: Callable[..., Any]
    merge: Callable[[Any, Any], Any]
    finish: Callable[[Any], Any]


def _partials(agg: Aggregate, n_keys: int, most_keys: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        states: dict[tuple, Any] = {}
        schema: pa.Schema | None = None

        def out() -> pa.RecordBatch:
            keys = [pa.array([k[i] for k in states], schema.field(i).type) for i in range(n_keys)]
            packed = pa.array([pickle.dumps(s) for s in states.values()], pa.binary())
            return pa.RecordBatch.from_arrays([*keys, packed], names=[*schema.names[:n_keys], "state"])

        for batch in batches:
            schema = batch.schema
            columns = [c.to_pylist() for c in batch.columns]
            for row in zip(*columns):
                key = row[:n_keys]
                state = states[key] if key in states else agg.zero()
                states[key] = agg.add(state, *row[n_keys:])
            if len(states) > most_keys:
                yield out()
                states.clear()
        if states:
            yield out()

    return run


def _merger(agg: Aggregate, n_keys: int, last: bool, result: pa.DataType | None):
    """Merges partial states that follow each other by key."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, state, schema, done = None, None, None, []

        def out() -> pa.RecordBatch:
            keys = [pa.array([k[i] for k, _ in done], schema.field(i).type) for i in range(n_keys)]
            values = (pa.array([agg.finish(s) for _, s in done], result) if last
                      else pa.array([pickle.dumps(s) for _, s in done], pa.binary()))
            return pa.RecordBatch.from_arrays([*keys, values], names=[*schema.names[:n_keys], "state"])

        for batch in batches:
            schema = batch.schema
            for *k, packed in zip(*(c.to_pylist() for c in batch.columns)):
                s = pickle.loads(packed)
                if key is not None and k == key:
                    state = agg.merge(state, s)
                    continue
                if key is not None:
                    done.append((key, state))
                    if len(done) >= 10_000:
                        yield out()
                        done.clear()
                key, state = k, s
        if key is not None:
            done.append((key, state))
            yield out()

    return run


def aggregate_by(df: DataFrame, keys: Sequence[str], columns: Sequence[str], agg: Aggregate, result: str,
                 out_col: str = "value", fan: int = 16, most_keys: int = MOST_KEYS) -> DataFrame:
    """``(*keys, out_col)``: ``agg`` over ``columns`` per key; ``result`` is the
    SQL type of what ``finish`` returns."""
    from pyspark.sql.pandas.types import to_arrow_type
    from pyspark.sql.types import StructType

    keys = list(keys)
    rows = df.select(*keys, *[F.col(c).alias(f"_{i}") for i, c in enumerate(columns)])
    key_ddl = "".join(f"`{k}` {df.schema[k].dataType.simpleString()}, " for k in keys)
    partial = rows.mapInArrow(_partials(agg, len(keys), most_keys), key_ddl + "state binary")
    kind = to_arrow_type(StructType.fromDDL(f"x {result}")["x"].dataType)
    salt = F.pmod(F.spark_partition_id(), F.lit(fan))
    some = (partial.withColumn("_salt", salt).repartition(*keys, "_salt").sortWithinPartitions(*keys, "_salt")
            .select(*keys, "state").mapInArrow(_merger(agg, len(keys), False, None), key_ddl + "state binary"))
    whole = (some.repartition(*keys).sortWithinPartitions(*keys)
             .mapInArrow(_merger(agg, len(keys), True, kind), key_ddl + f"state {result}"))
    return whole.withColumnRenamed("state", out_col)


def _latest_two(state: list, t: int | None) -> list:
    return state if t is None else sorted([*state, t])[-2:]


# The time between the last two events: null with fewer than two.
LAST_GAP = Aggregate(list, _latest_two, lambda a, b: sorted(a + b)[-2:], lambda s: s[1] - s[0] if len(s) == 2 else None)


def _counted(state: dict, value) -> dict:
    if value is not None:
        state[value] = state.get(value, 0) + 1
    return state


def _added(a: dict, b: dict) -> dict:
    for value, n in b.items():
        a[value] = a.get(value, 0) + n
    return a


# The most frequent value, ties by the smallest; for columns of few values.
MODE = Aggregate(dict, _counted, _added, lambda s: min(s, key=lambda v: (-s[v], v)) if s else None)
