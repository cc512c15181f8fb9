"""Append-only tables in layers: every epoch adds a run, runs are merged by levels, one manifest commits all.

``Layers`` holds several tables under one root. Epoch ``N`` writes its rows of a table to
``<table>/batch=N``; once ``FANOUT`` runs stand on a level they are merged into one of the
next, so a table of n epochs is read from about ``FANOUT * log(n)`` folders and a row is
rewritten ``log(n)`` times. The manifest ``_epochs/v=N`` names the runs of every table; writing
it is the commit, so all tables of an epoch appear together. An epoch that is repeated starts
from the manifest before it and overwrites its own runs. A merged run's parts stay for one
more epoch, for the repetition and for readers of the manifest before.

A keyed table also has runs of its keys: hashes and keys in slices of about ``SLICE_KEYS``
rows by hash, and beside them a Bloom filter, one 64-bit word for about five keys, in the same
slices. ``absent`` looks a batch up in all runs at once: it reads the filter slices that the
batch's hashes fall in, and key slices only where a filter says that a key may be there. What
it reads follows the batch and the number of levels, not the history.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.session import exists, names_in, remove

FANOUT = 8
SLICE_KEYS = 1_000_000
#: Bits a key has in a filter, and how many of them it sets.
BITS, SET = 12, 4
_MANIFEST = "table string, run string, level int, rows bigint, words bigint, slices array<int>, gone boolean"


@dataclass
class Run:
    table: str
    run: str
    level: int
    rows: int = 0
    words: int = 0
    slices: list[int] = field(default_factory=list)


class Layers:
    def __init__(self, spark: SparkSession, root: str, schemas: dict[str, str], keys: dict[str, str] | None = None,
                 fanout: int = FANOUT, slice_keys: int | None = None):
        """``schemas``: columns of each table; ``keys``: the key column of those looked up by ``absent``."""
        self.spark, self.root, self.schemas, self.keys, self.fanout = spark, root, schemas, keys or {}, fanout
        self.slice_keys = slice_keys or SLICE_KEYS

    # ---------------------------------------------------------------- manifests

    def epochs(self) -> list[int]:
        names = names_in(self.spark, f"{self.root}/_epochs")
        return sorted(int(n[2:]) for n in names if n.startswith("v=") and exists(self.spark, f"{self.root}/_epochs/{n}/_SUCCESS"))

    def _manifest(self, epoch: int) -> list[tuple]:
        return [tuple(r) for r in self.spark.read.schema(_MANIFEST).parquet(f"{self.root}/_epochs/v={epoch}").collect()]

    def runs(self, before: int | None = None) -> list[Run]:
        """The runs as of the last epoch committed, or the last one before ``before``."""
        known = [e for e in self.epochs() if before is None or e < before]
        return [Run(*r[:5], list(r[5])) for r in self._manifest(known[-1]) if not r[6]] if known else []

    # ---------------------------------------------------------------- reading

    def _path(self, run: Run) -> str:
        return f"{self.root}/{run.table}/{run.run}"

    def read(self, table: str, runs: list[Run] | None = None) -> DataFrame:
        runs = self.runs() if runs is None else runs
        paths = [self._path(r) for r in runs if r.table == table and r.rows]
        return self.spark.read.schema(self.schemas[table]).parquet(*paths) if paths else self.spark.createDataFrame([], self.schemas[table])

    def _sliced(self, kind: str, schema: str, pairs: list[tuple[str, int]]) -> DataFrame:
        base = f"{self.root}/{kind}"
        paths = [f"{base}/run={run}/slice={s}" for run, s in pairs]
        schema = f"{schema}, run string, slice int"
        return self.spark.read.schema(schema).option("basePath", base).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def absent(self, table: str, rows: DataFrame, runs: list[Run], keep) -> DataFrame:
        """The rows whose key is in none of the runs; ``keep`` stores an intermediate table. Null keys are absent."""
        key, held = self.keys[table], [r for r in runs if r.table == table and r.rows]
        if not held:
            return rows
        one = rows.select(F.col(key).alias("key")).filter("key IS NOT NULL").distinct()
        each = F.explode(F.array(*[F.struct(F.lit(r.run).alias("run"), F.lit(r.words).alias("words"), F.lit(self._count(r.rows)).alias("n")) for r in held]))
        asked = keep(_placed(one.withColumn("r", each).select("key", "r.*")), "asked")
        stored = {(r.run, s) for r in held for s in r.slices}
        pairs = lambda df: sorted({(r.run, r.slice) for r in df.select("run", "slice").distinct().collect()} & stored)
        words = self._sliced(f"{table}_filter", "word bigint, bits bigint", pairs(asked)).select("run", "word", "bits")
        maybe = keep(asked.join(words, ["run", "word"]).filter((F.col("bits").bitwiseAND(F.col("mask"))) == F.col("mask")).select("run", "slice", "key"), "maybe")
        found = self._sliced(f"{table}_keys", "key string", pairs(maybe)).select("run", "key")
        seen = maybe.join(found, ["run", "key"], "left_semi").select(F.col("key").alias(key)).distinct()
        return rows.join(seen, key, "left_anti").select(*rows.columns)

    def _count(self, rows: int) -> int:
        return max(1, -(-rows // self.slice_keys))

    # ---------------------------------------------------------------- writing

    def _write_keys(self, table: str, run: str, keys: DataFrame, rows: int) -> Run:
        words, count = max(1, -(-rows * BITS // 64)), self._count(rows)
        placed = _placed(keys.select(F.col(self.keys[table]).cast("string").alias("key")).filter("key IS NOT NULL")
                         .withColumns({"run": F.lit(run), "words": F.lit(words), "n": F.lit(count)}))
        for kind, part in (("keys", placed.select("key", "slice")),
                           ("filter", placed.groupBy("slice", "word").agg(F.bit_or("mask").alias("bits")))):
            (part.repartition(min(count, 256), "slice").sortWithinPartitions("slice", "key" if kind == "keys" else "word")
             .write.mode("overwrite").partitionBy("slice").parquet(f"{self.root}/{table}_{kind}/run={run}"))
        slices = sorted(int(n[6:]) for n in names_in(self.spark, f"{self.root}/{table}_keys/run={run}") if n.startswith("slice="))
        return Run(table, run, 0, rows, words, slices)

    def _write(self, table: str, run: str, df: DataFrame) -> Run:
        path = f"{self.root}/{table}/{run}"
        df.write.mode("overwrite").parquet(path)
        stored = self.spark.read.schema(self.schemas[table]).parquet(path)
        rows = stored.count()
        if table in self.keys and rows:
            return self._write_keys(table, run, stored, rows)
        return Run(table, run, 0, rows)

    def _merged(self, table: str, level: int, parts: list[Run], epoch: int) -> Run:
        """One run of the next level with the rows of all parts; keys and filter are built anew for their number."""
        made = self._write(table, f"level={level + 1}-{epoch}", self.read(table, parts).hint("rebalance"))
        made.level = level + 1
        return made

    def commit(self, epoch: int, added: dict[str, DataFrame]) -> list[Run]:
        """Write the epoch's rows of every table, merge full levels, and make all of it visible at once."""
        before = [e for e in self.epochs() if e < epoch]
        kept, old = self.runs(epoch), [r for r in self._manifest(before[-1]) if r[6]] if before else []
        gone: list[Run] = []
        for table, df in added.items():
            kept.append(self._write(table, f"batch={epoch}", df))
            level = 0
            while len(parts := [r for r in kept if r.table == table and r.level == level]) >= self.fanout:
                merged = self._merged(table, level, parts, epoch)
                kept = [r for r in kept if r not in parts] + [merged]
                gone += parts
                level += 1
        rows = [(r.table, r.run, r.level, r.rows, r.words, r.slices, mark) for mark, some in ((False, kept), (True, gone)) for r in some]
        self.spark.createDataFrame(rows, _MANIFEST).coalesce(1).write.mode("overwrite").parquet(f"{self.root}/_epochs/v={epoch}")
        # What the epoch before merged is read by no epoch that may still be repeated.
        for table, run, *_ in old:
            for path in (f"{table}/{run}", f"{table}_keys/run={run}", f"{table}_filter/run={run}"):
                remove(self.spark, f"{self.root}/{path}")
        for e in before[:-1]:
            remove(self.spark, f"{self.root}/_epochs/v={e}")
        return kept


def _placed(keys: DataFrame) -> DataFrame:
    """Adds the filter word, the slice and the bits of ``key`` in a run of ``words`` words and ``n`` slices."""
    word = F.pmod(F.xxhash64("key"), F.col("words").cast("bigint"))
    other = F.xxhash64("key", F.lit(1))
    mask = None
    for i in range(SET):
        bit = F.expr(f"shiftleft(1L, cast(shiftrightunsigned(other, {6 * i}) & 63 as int))")
        mask = bit if mask is None else mask.bitwiseOR(bit)
    placed = keys.withColumns({"word": word, "other": other})
    return placed.withColumns({"mask": mask, "slice": F.floor(F.col("word") * F.col("n") / F.col("words")).cast("int")}).drop("other", "words", "n")
