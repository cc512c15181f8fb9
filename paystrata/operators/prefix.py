"""Running values over one global order, without a one-task window.

The rows are range-partitioned and sorted on the order once; each range is folded in
one Arrow pass, which adds the running value inside the range, and written with its
range number: range boundaries are sampled, so what follows must see the same split.
The fold of each range (one row per range) then gives the next ones their offset.
How many ranges there are follows from the number of rows. The order must be unique, so
ranges stay even whatever the values are.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.functions.parse import _col
from paystrata.session import materialize

_FOLDS = {"sum": F.sum, "max": F.max}
#: Rows a range holds on average at most.
ROWS_PER_RANGE = 2_000_000


def ranges_of(df: DataFrame, rows_per_range: int = ROWS_PER_RANGE) -> int:
    """Enough ranges for every core, and no more rows than ``rows_per_range`` in one on average."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-df.count() // rows_per_range))


def _least(kind: pa.DataType) -> pa.Scalar:
    return pa.scalar(float("-inf") if pa.types.is_floating(kind) else -(2 ** (kind.bit_width - 1)), kind)


def _local(values: dict[str, str], how: dict[str, str]) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adds the running value inside the task's range and the range's number."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: dict[str, pa.Scalar | None] = dict.fromkeys(values)
        for batch in batches:
            if not batch.num_rows:
                continue
            columns, names = list(batch.columns), list(batch.schema.names)
            for name, value in values.items():
                array = batch.column(names.index(value))
                kind = array.type
                if pa.types.is_timestamp(kind):
                    array = array.cast(pa.int64())
                start = _least(array.type) if last[name] is None and how[name] == "max" else last[name]
                fold = pc.cumulative_sum if how[name] == "sum" else pc.cumulative_max
                # A null leaves the running value as it is; before any value it is null.
                run_ = pc.fill_null_forward(fold(array, start, skip_nulls=True))
                if last[name] is not None:
                    run_ = pc.fill_null(run_, last[name])
                if run_[-1].is_valid:
                    last[name] = run_[-1]
                columns.append(run_.cast(kind))
                names.append(f"__l_{name}")
            columns.append(pa.array([TaskContext.get().partitionId()] * batch.num_rows, pa.int32()))
            yield pa.RecordBatch.from_arrays(columns, names=[*names, "__range"])
    return run


def running(
    df: DataFrame, order: list[str], folds: dict[str, tuple[str, Column | str]], ranges: int | None = None,
    keep: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """Adds one running column per fold: ``{"total": ("sum", "amount")}``.

    The current row is included, as in ``rowsBetween(unboundedPreceding, 0)``. ``keep``
    writes the ranges; a caller that removes its scratch tables passes its own.
    """
    values = {name: f"__v_{name}" for name in folds}
    valued = df.withColumns({values[name]: _col(value) for name, (_, value) in folds.items()})
    ranges = ranges or ranges_of(df)
    fields = [*valued.schema.fields, *(T.StructField(f"__l_{n}", valued.schema[v].dataType) for n, v in values.items()),
              T.StructField("__range", T.IntegerType())]
    local = (valued.repartitionByRange(ranges, *order).sortWithinPartitions(*order)
             .mapInArrow(_local(values, {name: how for name, (how, _) in folds.items()}), T.StructType(fields)))
    ranged = keep(local, "ranges")

    totals = ranged.groupBy("__range").agg(*[_FOLDS[how](values[name]).alias(f"__t_{name}") for name, (how, _) in folds.items()])
    before = Window.orderBy("__range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    offsets = totals.select("__range", *[
        _FOLDS[how](f"__t_{name}").over(before).alias(f"__o_{name}") for name, (how, _) in folds.items()])

    joined = ranged.join(F.broadcast(offsets), "__range")
    results = {}
    for name, (how, _) in folds.items():
        local_, offset = F.col(f"__l_{name}"), F.col(f"__o_{name}")
        results[name] = (F.greatest(local_, offset) if how == "max"
                         else F.when(offset.isNull(), local_).when(local_.isNull(), offset).otherwise(local_ + offset))
    return joined.withColumns(results).drop("__range", *[f"__{x}_{name}" for name in folds for x in "vlo"])


def row_numbers(df: DataFrame, order: list[str], name: str = "row_id", start: int = 0,
                keep: Callable[[DataFrame, str], DataFrame] = materialize) -> DataFrame:
    """Consecutive numbers ``start + 1 …`` in a global order."""
    numbered = running(df, order, {name: ("sum", F.lit(1).cast("bigint"))}, keep=keep)
    return numbered.withColumn(name, F.col(name) + F.lit(start)) if start else numbered


def running_volume(df: DataFrame, order: list[str], amount: str = "amount") -> DataFrame:
    return running(df, order, {"cumulative": ("sum", amount)})


def late_flags(
    df: DataFrame, order: list[str], event_ts: str = "event_ts", lateness_seconds: int = 10,
    carried_max: Column | None = None, keep: Callable[[DataFrame, str], DataFrame] = materialize,
) -> DataFrame:
    """``late``: event time strictly before (largest so far − lateness).

    ``carried_max`` is the maximum left by earlier batches of a stream.
    """
    flagged = running(df, order, {"max_event_ts": ("max", F.col(event_ts))}, keep=keep)
    if carried_max is not None:
        flagged = flagged.withColumn("max_event_ts", F.greatest("max_event_ts", carried_max))
    limit = F.col("max_event_ts") - F.make_dt_interval(secs=F.lit(lateness_seconds))
    return flagged.withColumn("late", F.coalesce(F.col(event_ts) < limit, F.lit(False)))
