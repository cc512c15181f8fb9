"""A keyed table in hash buckets: a write rewrites the buckets that hold one of its keys.

``root/data/v=N/bucket=B`` holds what write N wrote; ``root/manifest/v=N`` says for every
bucket which write holds it as of version N, and how many rows. A version is the manifest's
set of folders, so old versions stay readable, a reader never sees half a write, and a write
that is repeated overwrites its own two folders alone. ``vacuum`` removes folders that no kept
manifest names.

The bucket is a hash of the keys modulo the number of buckets, which the manifest records. A
key that is updated by any number of rows is one row before it is written, so a hot key does
not make a bucket hot. ``grow`` multiplies the buckets; each is then split by itself. The
driver reads manifests only: one row a bucket.
"""

from __future__ import annotations

import json
from typing import NamedTuple

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from paystrata.operators.dedup import latest_per_key
from paystrata.session import exists, remove

BUCKET = "bucket"
#: Buckets of a table unless it says otherwise; about one for each 128 MB that it will hold.
BUCKETS = 16
_MANIFEST = f"{BUCKET} int, written bigint, rows bigint, schema string"


class Change(NamedTuple):
    """What an upsert did: the rows that came, those they took the place of, the buckets written."""
    came: DataFrame
    went: DataFrame
    buckets: list[int]


class Buckets:
    def __init__(self, spark: SparkSession, root: str, keys: list[str], count: int = BUCKETS):
        self.spark, self.root, self.keys, self.count, self.schema = spark, root, keys, count, None

    # ---------------------------------------------------------------- reading

    def _data(self, version: int) -> str:
        return f"{self.root}/data/v={version}"

    def exists(self, version: int) -> bool:
        return exists(self.spark, f"{self.root}/manifest/v={version}/_SUCCESS")

    def manifest(self, version: int) -> DataFrame:
        """(bucket, written, rows) as of a version, and a row of bucket -1 with the table's schema and
        number of buckets."""
        return self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/manifest/v={version}")

    def _held(self, version: int) -> dict[int, tuple[int, int]]:
        found = {r[BUCKET]: r for r in self.manifest(version).collect()}
        table = found.pop(-1)
        self.count, self.schema = table["rows"], T.StructType.fromJson(json.loads(table["schema"]))
        return {b: (r["written"], r["rows"]) for b, r in found.items()}

    def _read(self, held: dict[int, tuple[int, int]], wanted=None) -> DataFrame:
        paths = [f"{self._data(v)}/{BUCKET}={b}" for b, (v, _) in sorted(held.items()) if wanted is None or b in wanted]
        return self.spark.read.schema(self.schema).parquet(*paths) if paths else self.spark.createDataFrame([], self.schema)

    def read(self, version: int) -> DataFrame:
        return self._read(self._held(version))

    def lookup(self, version: int, keys: DataFrame) -> DataFrame:
        """Rows whose key is in ``keys``; reads the buckets of those keys only."""
        held = self._held(version)
        wanted = {r[0] for r in keys.select(self.bucket()).distinct().collect()}
        return self._read(held, wanted).join(keys.select(*self.keys).distinct(), self.keys, "left_semi")

    # ---------------------------------------------------------------- writing

    def bucket(self) -> Column:
        return F.pmod(F.xxhash64(*self.keys), F.lit(self.count)).cast("int").alias(BUCKET)

    def _write(self, df: DataFrame, version: int, held: dict[int, tuple[int, int]]) -> None:
        """The given rows as the whole content of their buckets, beside those of ``held``."""
        # Rebalanced by size, so a large bucket is several files and small ones share a task.
        df.withColumn(BUCKET, self.bucket()).hint("rebalance", BUCKET).write.mode("overwrite").partitionBy(BUCKET).parquet(self._data(version))
        # Counts come from the footers: no column is read.
        written = self.spark.read.schema(T.StructType([*df.schema.fields, T.StructField(BUCKET, T.IntegerType())])).parquet(self._data(version))
        sizes = dict(written.groupBy(BUCKET).count().collect())
        rows = [(b, v, n, None) for b, (v, n) in held.items() if b not in sizes]
        rows += [(b, version, n, None) for b, n in sizes.items()] + [(-1, version, self.count, df.schema.json())]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/manifest/v={version}")

    def overwrite(self, df: DataFrame, version: int) -> DataFrame:
        """``df``, one row a key, as the whole table."""
        self._write(df, version, {})
        return self.read(version)

    def upsert(self, updates: DataFrame, version: int, mode: str = "replace", order: list[str] | None = None) -> Change:
        """Version ``version`` from the one before it: the keys of ``updates`` replaced or updated.

        ``order`` names the arrival columns when ``updates`` repeats keys. ``Change.went`` reads
        the version before, so a summary can take back what was replaced without reading the
        buckets that did not change.
        """
        from paystrata.sources.tables import upsert  # the keyed join itself
        held = self._held(version - 1)
        incoming = latest_per_key(updates, self.keys, order) if order else updates
        # Written once: its buckets, the join and the caller's summary read it.
        path = f"{self.root}/came/v={version}"
        incoming.write.mode("overwrite").parquet(path)
        came = self.spark.read.schema(incoming.schema).parquet(path)
        touched = sorted(r[0] for r in came.select(self.bucket()).distinct().collect())
        before = self._read(held, set(touched))
        went = before.join(came.select(*self.keys), self.keys, "left_semi")
        self._write(upsert(before, came, self.keys, mode), version, held)
        return Change(came, went, touched)

    def delete(self, keys: DataFrame, version: int) -> None:
        """Version ``version`` without the rows of these keys."""
        held = self._held(version - 1)
        touched = {r[0] for r in keys.select(self.bucket()).distinct().collect()}
        left = self._read(held, touched).join(keys.select(*self.keys), self.keys, "left_anti")
        self._write(left, version, {b: v for b, v in held.items() if b not in touched})

    def grow(self, version: int, times: int) -> None:
        """Version ``version`` with ``times`` as many buckets and the same rows."""
        before = self.read(version - 1)
        self.count *= times
        self._write(before, version, {})

    def vacuum(self, first: int, last: int) -> int:
        """Remove what only versions before ``first`` read; ``last`` is the newest. Returns the folders removed."""
        needed = {(v, b) for n in range(first, last + 1) if self.exists(n) for b, (v, _) in self._held(n).items()}
        gone = 0
        for n in range(first):
            if not self.exists(n):
                continue
            for b, (v, _) in self._held(n).items():
                path = f"{self._data(v)}/{BUCKET}={b}"
                if (v, b) not in needed and exists(self.spark, path):
                    remove(self.spark, path)
                    gone += 1
            for part in ("manifest", "came"):
                remove(self.spark, f"{self.root}/{part}/v={n}")
        return gone
