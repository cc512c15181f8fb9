"""Streams that survive their input: retry, poison pills to the dead letters, one commit for all sinks.

``guarded`` runs a batch through a transform that gives rows for several sinks. All of them
are written as runs of a layered store and become visible by one manifest, so a batch is
either in every sink or in none. A batch that fails is tried again. If the reason may pass
(storage, network, a lost executor) the error is raised once the attempts are used up, and the
offsets stay where they are. If it lies in the rows, they are halved by hash until the rows
that raise stand alone: these go to the dead letters with their error, the others to the
sinks. One raising row of n costs about 2 log2(n) trial runs, each over a part of the batch.

More than ``most`` raising rows are no pills but a fault of the transform: the error is
raised, and no row is lost. Equal rows share a hash and a fate. The transform must not look
from one row to another for its errors to be found this way.
"""

from __future__ import annotations

import re
import time
from collections.abc import Callable

from pyspark.errors import PySparkException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from paystrata.session import scratch
from paystrata.sources.layers import Layers

Transform = Callable[[DataFrame], dict[str, DataFrame]]
DEAD = "failed_payload string, error string, origin string"
_POSITION = "__position"
_FIRST, _LAST = -(1 << 63), (1 << 63) - 1
#: Names in an error that say the reason may pass.
_PASSING = re.compile(r"IOException|FileNotFound|FileAlreadyExists|ConnectException|SocketException|Timeout|FetchFailed|ExecutorLost|ExecutorDeadException|"
                      r"OutOfMemory|No space left|ConnectionError|BrokenPipe|OSError|MetadataFetchFailed|CommitDenied")
#: The line of an error that names its reason.
_REASON = re.compile(r"^(?:\w+(?:\.\w+)*(?:Error|Exception): .*|\[[A-Z_.]+\].*)$", re.M)


class TooManyFailures(RuntimeError):
    """So many rows raise that the transform must be at fault."""


def passes(error: Exception) -> bool:
    """Whether the reason of an error may be gone at the next attempt."""
    return not isinstance(error, PySparkException) or bool(_PASSING.search(str(error)))


def reason(error: Exception) -> str:
    """What an error says, without the trace around it."""
    found = [x.strip() for x in _REASON.findall(str(error))]
    return (found[-1] if found else str(error).strip().split("\n")[0])[:500]


def _fails(transform: Transform, rows: DataFrame) -> Exception | None:
    try:
        for df in transform(rows.drop(_POSITION)).values():
            df.write.format("noop").mode("overwrite").save()
    except Exception as error:  # noqa: BLE001 - told apart by the caller
        if passes(error):
            raise
        return error
    return None


def raising_rows(rows: DataFrame, transform: Transform, most: int) -> dict[int, str]:
    """Position and error of every row that makes the transform raise."""
    found: dict[int, str] = {}
    parts = [(_FIRST, _LAST, False)]
    while parts:
        low, high, surely = parts.pop()
        part = rows.filter((F.col(_POSITION) >= low) & (F.col(_POSITION) <= high))
        least, last = part.agg(F.min(_POSITION), F.max(_POSITION)).first()
        if least is None:
            continue
        error = None if surely and least < last else _fails(transform, part)
        if error is None and not surely:
            continue
        if least == last:
            if error is not None:
                found[least] = reason(error)
            if len(found) > most:
                raise TooManyFailures(f"more than {most} rows raise, such as: {reason(error)}")
            continue
        middle = (least + last) // 2
        # If the lower half is fine, the upper one is known to raise.
        lower = part.filter(F.col(_POSITION) <= middle)
        if _fails(transform, lower) is None:
            parts.append((middle + 1, last, True))
        else:
            parts += [(middle + 1, last, False), (least, middle, True)]
    return found


def guarded(batch: DataFrame, epoch: int, store: Layers, transform: Transform, origin: str, dead: str = "dlq",
            attempts: int = 3, wait: float = 1.0, most: int = 100) -> int:
    """One batch to all sinks of ``store``; returns how many different rows went to the dead letters."""
    with scratch(batch.sparkSession) as keep:
        # Stored once, so that every attempt and every half sees the same rows.
        rows = keep(batch.withColumn(_POSITION, F.xxhash64(*batch.columns)), "guarded")
        letters = store.read(dead, [])
        pills: dict[int, str] = {}
        for attempt in range(1, attempts + 1):
            try:
                store.commit(epoch, transform(rows.drop(_POSITION)) | {dead: letters})
                return 0
            except Exception as error:  # noqa: BLE001
                if attempt == attempts and passes(error):
                    raise
            time.sleep(wait * attempt)
        pills = raising_rows(rows, transform, most)
        spark = batch.sparkSession
        told = spark.createDataFrame(list(pills.items()), f"{_POSITION} bigint, error string")
        bad = rows.join(F.broadcast(told), _POSITION)  # at most ``most`` rows
        letters = bad.select(F.to_json(F.struct(*batch.columns)).alias("failed_payload"), "error", F.lit(origin).alias("origin"))
        fine = rows.filter(~F.col(_POSITION).isin(list(pills))) if pills else rows
        store.commit(epoch, transform(fine.drop(_POSITION)) | {dead: letters})
        return len(pills)


def start_guarded(events: DataFrame, root: str, schemas: dict[str, str], transform: Transform, origin: str,
                  trigger: dict | None = None, **options) -> StreamingQuery:
    """A stream whose batches go through ``guarded`` into the tables ``schemas`` under ``root``."""
    store = Layers(events.sparkSession, root, schemas | {"dlq": DEAD})
    return (events.writeStream.queryName("guarded")
            .foreachBatch(lambda df, i: guarded(df, i, store, transform, origin, **options) and None)
            .option("checkpointLocation", f"{root}/_checkpoints/guarded").trigger(**(trigger or {"availableNow": True})).start())


def read_guarded(spark, root: str, schemas: dict[str, str], name: str) -> DataFrame:
    """A sink of ``start_guarded``, all committed batches."""
    return Layers(spark, root, schemas | {"dlq": DEAD}).read(name)
