"""Secret scans, in DataFrame functions only.

Three base kinds are found by pattern; character Markov models add a fourth, ``random``:
runs of at least ``RUN`` key characters whose log-likelihood under a bigram model of
random strings exceeds that under a model of ordinary identifiers. Both models are
trained on labelled samples: the values the base patterns found anywhere (random), and
the identifiers of about ``SAMPLE`` documents, taken by a hash of their ids (ordinary; the
documented bound). One pass over the texts writes all matches with their places; the
rest works on those. A run is cut at the base spans it overlaps, and each remaining part of
``RUN`` characters or more is judged by itself.

Places are code points, ends exclusive. A null text is empty. Without any base match all
characters are as likely in a random string. Repeated rows are scanned each time; an empty
table gives no rows.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import Scratch, documents
from paystrata.llm.registry import query

KEYWORDS = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
#: Kind, pattern, group whose length counts, least length.
BASE = [
    ("assign", f"({KEYWORDS})[\"']?\\x20*[:=]\\x20*[\"']?([A-Za-z0-9+/_.=-]+)", 2, 8),
    ("access", "AKIA[A-Z0-9]+", 0, 16),
    ("hex", "[0-9a-f]+", 0, 32),
]
RUN = 20
RUNS = f"[A-Za-z0-9+/_=-]{{{RUN},}}"
IDENTIFIER = "[A-Za-z0-9_]{6,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"
SAMPLE = 2000
#: Least mean log-likelihood ratio per character, and least sum, in nats.
LEAST_MEAN, LEAST_SUM = 0.5, 12.0
KINDS = [k for k, *_ in BASE] + ["random"]
SPAN = "array<struct<start:int,kind:int,end:int,value:string>>"


def matches(text: Column, pattern: str, group: int, least: int, kind: int) -> Column:
    """Leftmost non-overlapping matches with their places; what stands between two matches gives the distance."""
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    gaps = F.split(text, pattern, -1)

    def placed(both: Column) -> Column:
        zero = F.struct(F.lit(0).alias("at"), F.lit(None).cast(SPAN).alias("out"))

        def step(acc: Column, i: Column) -> Column:
            start = acc["at"] + F.length(F.get(both["gaps"], i))
            value = F.get(both["found"], i)
            end = start + F.length(value)
            core = value if not group else F.regexp_extract(value, pattern, group)
            one = F.array(F.struct(start.alias("start"), F.lit(kind).alias("kind"), end.alias("end"), core.alias("value"))).cast(SPAN)
            out = F.coalesce(acc["out"], F.array().cast(SPAN))
            return F.struct(end.alias("at"), F.when(F.length(core) >= least, F.concat(out, one)).otherwise(out).alias("out"))

        return F.aggregate(F.sequence(F.lit(0), F.size(both["found"]) - 1), zero, step)["out"]

    def some(all_found: Column) -> Column:
        both = F.transform(F.array(F.struct(all_found.alias("found"), gaps.alias("gaps"))), placed)
        return F.when(F.size(all_found) > 0, F.get(both, F.lit(0))).otherwise(F.array().cast(SPAN))

    return F.get(F.transform(F.array(found), some), F.lit(0))


def outside(run: Column, base: Column) -> Column:
    """The parts of a run before, between and after the base spans, sorted by start, that overlap it."""
    cuts = F.filter(base, lambda b: (b["start"] < run["end"]) & (run["start"] < b["end"]))
    zero = F.struct(run["start"].alias("at"), F.array().cast(SPAN).alias("out"))

    def part(start: Column, end: Column) -> Column:
        value = F.substring(run["value"], start - run["start"] + 1, end - start)
        return F.array(F.struct(start.alias("start"), run["kind"].alias("kind"), end.alias("end"), value.alias("value"))).cast(SPAN)

    def longer(out: Column, start: Column, end: Column) -> Column:
        return F.when(end - start >= RUN, F.concat(out, part(start, end))).otherwise(out)

    def step(acc: Column, b: Column) -> Column:
        return F.struct(F.greatest(acc["at"], b["end"]).alias("at"), longer(acc["out"], acc["at"], b["start"]).alias("out"))

    cut = F.aggregate(cuts, zero, step, lambda acc: longer(acc["out"], acc["at"], run["end"]))
    return F.when(F.size(cuts) == 0, F.array(run).cast(SPAN)).otherwise(cut)


def scanned(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``base`` and ``runs``: base spans by place, and the parts of runs of key characters clear of them."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    # A run shorter than the least length is dropped anyway; asking for it at once finds the same spans.
    patterns = [(p if k == "assign" else p.replace("[0-9a-f]+", "[0-9a-f]{32,}").replace("[A-Z0-9]+", "[A-Z0-9]{12,}"), g, n) for k, p, g, n in BASE]
    base = F.array_sort(F.concat(*(matches(F.col("__t"), p, g, n, i) for i, (p, g, n) in enumerate(patterns))))
    runs = matches(F.col("__t"), RUNS, 0, RUN, len(BASE))
    clear = F.flatten(F.transform("runs", lambda r: outside(r, F.col("base"))))
    return docs.select(*keep, text.alias("__t")).select(*keep, base.alias("base"), runs.alias("runs")).withColumn("runs", clear)


def bigrams(values: DataFrame) -> DataFrame:
    """Counts of character pairs of the column ``value`` within the alphabet."""
    pair = F.explode(F.transform(F.sequence(F.lit(1), F.length("value") - 1), lambda i: F.substring(F.col("value"), i, F.lit(2))))
    return values.filter(F.length("value") >= 2).select("label", pair.alias("pair")).groupBy("label", "pair").agg(F.count("*").alias("n"))


def train(found: DataFrame, docs: DataFrame) -> list[float]:
    """Log-likelihood ratio of each character after another: random strings against ordinary identifiers."""
    random = found.select(F.explode("base.value").alias("value"), F.lit("random").alias("label"))
    rows = docs.filter(F.col("text").isNotNull()).select("doc_id", "text")
    share = SAMPLE / max(rows.count(), 1)  # by hash, so no task gathers the sample
    sample = rows.filter(F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) < F.lit(int(min(1.0, share) * (1 << 30))))
    ordinary = (sample.select(F.explode(F.regexp_extract_all("text", F.lit(IDENTIFIER), F.lit(0))).alias("value"), F.lit("ordinary").alias("label"))
                .filter(~F.col("value").rlike("[0-9]{3}|[0-9][A-Za-z]+[0-9]")))
    # At most two rows per pair of characters of the alphabet.
    within = F.col("pair").rlike(f"^[{ALPHABET[:-1]}-]{{2}}$")
    counts = {(r.label, r.pair): r.n for r in bigrams(random.unionByName(ordinary)).filter(within).collect()}
    size, out = len(ALPHABET), []
    totals = {(label, a): sum(counts.get((label, a + b), 0) for b in ALPHABET) for label in ("random", "ordinary") for a in ALPHABET}
    for a in ALPHABET:
        for b in ALPHABET:
            p, q = ((counts.get((label, a + b), 0) + 0.5) / (totals[label, a] + 0.5 * size) for label in ("random", "ordinary"))
            out.append(math.log(p / q))
    return out


def likelihood_ratio(value: Column, ratios: Column) -> Column:
    index = F.transform(F.split(value, ""), lambda c: F.instr(F.lit(ALPHABET), c) - 1)

    def total(ix: Column) -> Column:
        pairs = F.sequence(F.lit(1), F.size(ix) - 1)
        add = lambda s, i: s + F.get(ratios, F.get(ix, i - 1) * len(ALPHABET) + F.get(ix, i))
        return F.when(F.size(ix) < 2, F.lit(0.0)).otherwise(F.aggregate(pairs, F.lit(0.0), add))

    return F.get(F.transform(F.array(index), total), F.lit(0))


def listed(spans: Column) -> Column:
    names = F.array(*map(F.lit, KINDS))
    return F.concat_ws(",", F.transform(spans, lambda s: F.concat_ws(":", F.get(names, s["kind"]), s["start"].cast("string"), s["end"].cast("string"))))


def added(ratios: list[float]) -> Column:
    """Spans of the runs that the models call random."""
    table = F.split(F.lit(" ".join(map(repr, ratios))), " ").cast("array<double>")  # one folded literal
    return F.filter("runs", lambda r: likelihood_ratio(r["value"], table) >= F.greatest(F.lit(LEAST_SUM), LEAST_MEAN * F.length(r["value"])))


def scan(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with ``base`` and ``all_spans``, arrays of (start, kind, end, value)."""
    found = Scratch(docs.sparkSession).keep(scanned(docs, keep), "secrets")
    return found.withColumn("all_spans", F.array_sort(F.concat("base", added(train(found, docs))))).drop("runs")


MASK = "[secret]"


def redacted(text: Column, spans: Column) -> Column:
    """The text with each stretch of spans replaced by ``MASK``."""
    start = F.struct(F.lit(0).alias("at"), F.lit("").alias("out"))

    def step(acc: Column, s: Column) -> Column:
        gap = F.when(s["start"] >= acc["at"], F.concat(F.substring(text, acc["at"] + 1, s["start"] - acc["at"]), F.lit(MASK))).otherwise(F.lit(""))
        return F.struct(F.greatest(acc["at"], s["end"]).alias("at"), F.concat(acc["out"], gap).alias("out"))

    end = lambda acc: F.concat(acc["out"], F.substring(text, acc["at"] + 1, F.length(text)))
    return F.when(F.size(spans) == 0, text).otherwise(F.aggregate(spans, start, step, end))


def redact(docs: DataFrame, scratch: Scratch) -> DataFrame:
    """``docs`` with their secrets masked; the models come from a first pass, the texts are never moved."""
    found = scratch.keep(scanned(docs, ["doc_id"]).select("base"), "secrets")
    spans = F.array_sort(F.concat("base", added(train(found, docs))))
    rows = scanned(docs, docs.columns).withColumn("__spans", spans)
    return rows.select(*(redacted(F.col("text"), F.col("__spans")).alias("text") if c == "text" else c for c in docs.columns))


@query("op9_secrets")
def secret_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spans of secrets of every document."""
    rows = scan(documents(spark, sf_dir).select(F.col("doc_id").cast("bigint"), "text"), ["doc_id"])
    n = lambda kind: F.size(F.filter("base", lambda s: s["kind"] == kind)).cast("bigint")
    return rows.select("doc_id", *(n(i).alias(f"n_{k}") for i, (k, *_) in enumerate(BASE)),
                       F.sha2(listed(F.col("base")).cast("binary"), 256).alias("base_sha256"), listed(F.col("all_spans")).alias("spans"))
