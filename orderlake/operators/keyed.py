"""Building blocks that stay exact when one key, or one moment, holds a large share of all rows.

Every helper reduces on the map side first, and then works on rows whose number per key is bounded by the calendar
(key x time slice), never by the number of events.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import Window
from pyspark.sql.pandas.types import to_arrow_type

SLICE = "_slice"


def computed_once(df: DataFrame, keep: list[str], columns: dict[str, Column]) -> DataFrame:
    """``keep`` plus new columns that are evaluated exactly once per row.

    A plain projection may be inlined into every later filter and projection that uses it, which repeats costly parsing many
    times; a one-row generator is a boundary the optimizer does not inline across.
    """
    row = F.struct(*[c.alias(n) for n, c in columns.items()])
    return df.select(*keep, F.inline(F.array(row)))


def latest_per_key(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """Row with the greatest ``order`` tuple per key; NULL sorts lowest.

    A first-row filter over a window has a group limit on both sides of its one shuffle, so a key's rows collapse before it.
    """
    newest = Window.partitionBy(*keys).orderBy(*[c.desc_nulls_last() for c in order])
    return df.withColumn("_newest", F.row_number().over(newest)).where("_newest = 1").drop("_newest")


FLUSH_ROWS = 20_000


def _changes(column: pa.ChunkedArray) -> np.ndarray:
    """Whether each value but the first differs from the one before it; NULL is a value."""
    codes = pc.dictionary_encode(column, null_encoding="encode").combine_chunks()
    codes = (codes.chunk(0) if isinstance(codes, pa.ChunkedArray) else codes).indices.to_numpy()
    return codes[1:] != codes[:-1]


def map_groups(df: DataFrame, keys: list[str], order: list[str], schema: str,
               fn: Callable[[tuple, dict[str, np.ndarray]], dict[str, np.ndarray] | None]) -> DataFrame:
    """``fn(key, columns)`` for every group, its rows in ``order``; the result has the keys followed by ``schema``.

    NULL is a key like any other. Groups must be bounded: callers key them by time slice or reduce them first. Spark sorts the rows by key, and a task
    cuts its batches where the key changes, so many small groups cost no Arrow table and no round trip each.
    """
    fields = df.sparkSession.createDataFrame([], schema).schema
    types = [(f.name, to_arrow_type(f.dataType)) for f in fields]
    key_schema = ", ".join(f"{k} {df.schema[k].dataType.simpleString()}" for k in keys)

    def groups(rows: pa.Table, starts: list[int]) -> Iterator[pa.RecordBatch]:
        ends = [*starts[1:], len(rows)]
        whole = {c: None if rows.column(c).null_count else rows.column(c).to_numpy() for c in rows.column_names}
        names = list(zip(*[rows.column(k).take(pa.array(starts, pa.int64())).to_pylist() for k in keys]))
        parts, origins, sizes, held = {n: [] for n, _ in types}, [], [], 0
        for i, (lo, hi) in enumerate(zip(starts, ends)):
            out = fn(names[i], {c: rows.column(c).slice(lo, hi - lo).to_numpy() if v is None else v[lo:hi] for c, v in whole.items()})
            made = {n: pa.array(out[n], t) for n, t in types} if out else {}
            if made and len(made[types[0][0]]):
                origins.append(lo)
                sizes.append(len(made[types[0][0]]))
                held += sizes[-1]
                for n, values in made.items():
                    parts[n].append(values)
            if held >= FLUSH_ROWS or held and hi == len(rows):
                spots = pa.array(np.repeat(np.array(origins, np.int64), sizes))
                told = pa.table({**{k: rows.column(k).take(spots) for k in keys}, **{n: pa.chunked_array([pa.concat_arrays(parts[n])], t) for n, t in types}})
                yield from told.combine_chunks().to_batches()
                parts, origins, sizes, held = {n: [] for n, _ in types}, [], [], 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_rows: list[pa.Table] = []  # of the one key that may go on
        for batch in batches:
            table = pa.Table.from_batches([batch])
            if not len(table):
                continue
            seen = pa.concat_tables([open_rows[-1].slice(len(open_rows[-1]) - 1), table]) if open_rows else table
            cuts = np.flatnonzero(np.logical_or.reduce([_changes(seen.column(k)) for k in keys])) + (0 if open_rows else 1)
            if not len(cuts):
                open_rows.append(table)
                continue
            done = pa.concat_tables([*open_rows, table.slice(0, cuts[-1])]).combine_chunks()
            before = sum(map(len, open_rows))
            starts = [0, *(int(c) + before for c in cuts[:-1])]
            yield from groups(done, starts)
            open_rows = [table.slice(cuts[-1])]
        if open_rows:
            yield from groups(pa.concat_tables(open_rows).combine_chunks(), [0])

    together = df.repartition(*keys).sortWithinPartitions(*keys, *[F.col(c).asc_nulls_last() for c in order])
    return together.mapInArrow(run, f"{key_schema}, {schema}")


def time_slice(ts: Column, seconds: int) -> Column:
    """Index of the fixed time slice a timestamp falls in."""
    return F.floor(F.unix_micros(ts) / F.lit(seconds * 1_000_000)).cast("bigint")


def running_sums(df: DataFrame, keys: list[str], order: list[str], slices: Column, sums: dict[str, Column],
                 peers: bool = False) -> DataFrame:
    """Inclusive running sums per key in two levels: inside a time slice, plus the total of all earlier slices.

    ``peers`` makes rows with equal order values share one result (a range frame over a single order column).
    """
    base = df.withColumns({SLICE: slices, **{f"_v_{n}": c for n, c in sums.items()}})
    totals = base.groupBy(*keys, SLICE).agg(*[F.sum(f"_v_{n}").alias(f"_t_{n}") for n in sums])
    before = Window.partitionBy(*keys).orderBy(SLICE).rowsBetween(Window.unboundedPreceding, -1)
    carry = totals.select(*keys, SLICE, *[F.coalesce(F.sum(f"_t_{n}").over(before), F.lit(0)).alias(f"_c_{n}") for n in sums])
    inside = Window.partitionBy(*keys, SLICE).orderBy(*order)
    frame = (inside.rangeBetween if peers else inside.rowsBetween)(Window.unboundedPreceding, Window.currentRow)
    joined = base.join(carry, [*keys, SLICE])
    out = joined.withColumns({n: F.sum(f"_v_{n}").over(frame) + F.col(f"_c_{n}") for n in sums})
    return out.select(*df.columns, *sums)


def ranks(df: DataFrame, keys: list[str], order: list[str], slices: Column, name: str = "rank") -> DataFrame:
    """1-based position per key; ``slices`` must be non-decreasing in ``order``."""
    return running_sums(df, keys, order, slices, {name: F.lit(1).cast("bigint")})


def as_of(left: DataFrame, right: DataFrame, key: str, left_ts: str, right_ts: str, reach_seconds: int, slice_seconds: int | None = None,
          tie: list[str] | None = None) -> DataFrame:
    """Left rows with the newest right row of the same key whose ``right_ts`` is not after ``left_ts`` (as struct ``match``), as far as it lies in the slices
    that ``reach_seconds`` before it touch; an older match may be missing.

    Only the newest right row of a (key, slice) can be the answer for later slices, so it alone is copied into those that can still see it, a
    bounded number. Then one window per (key, slice) serves all: no left x right pairs are formed, right rows are shuffled twice and left rows once.
    """
    seconds = slice_seconds or max(1, reach_seconds // 4)
    steps = -(-reach_seconds // seconds)
    order = F.struct(*[F.col(t) for t in tie or []], F.xxhash64(*right.columns))
    rights = right.where(F.col(key).isNotNull() & F.col(right_ts).isNotNull()).select(
        F.col(key).alias("_k"), F.col(right_ts).alias("_t"), time_slice(F.col(right_ts), seconds).alias(SLICE), order.alias("_o"), F.struct(*right.columns).alias("_m"))
    newest = latest_per_key(rights, ["_k", SLICE], [F.col("_t"), F.col("_o")])
    carried = newest.withColumn(SLICE, F.explode(F.sequence(F.col(SLICE) + 1, F.col(SLICE) + steps)))
    # Rows that can match nothing are spread over slices of their own.
    alone = F.xxhash64(*left.columns)
    lefts = left.select(
        F.col(key).alias("_k"), F.col(left_ts).alias("_t"),
        F.when(F.col(key).isNull() | F.col(left_ts).isNull(), alone).otherwise(time_slice(F.col(left_ts), seconds)).alias(SLICE), F.struct(*left.columns).alias("_l"))
    line = rights.unionByName(carried).withColumn("_side", F.lit(0)).unionByName(lefts.withColumn("_side", F.lit(1)), allowMissingColumns=True)
    inside = Window.partitionBy("_k", SLICE).orderBy("_t", "_side", "_o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return line.withColumn("match", F.last("_m", ignorenulls=True).over(inside)).where("_side = 1").select("_l.*", "match")
