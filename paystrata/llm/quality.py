"""Quality by weak supervision, in DataFrame functions only.

Rules on counts of a text vote good, bad, or abstain. Their accuracies are not set but
estimated: the votes of all documents are counted by pattern (a table as large as the
number of vote patterns, whatever the corpus), and expectation-maximisation runs over
that table until it settles. A document's posterior probability of being good follows
from its votes and the accuracies; it is kept at ``KEEP`` or more. An accuracy stays
within ``BOUNDS``, so a rule always speaks for the side it votes for.

Words are runs of anything but ASCII white space. A null text has none. An empty table
gives no rows; repeated rows are judged each time.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from paystrata.llm.common import Scratch, documents
from paystrata.llm.registry import query

SPACE = " \t\n\x0b\x0c\r"
GAP = "[\\x20\\x09-\\x0D]+"
SYMBOLS = "#*$%&|<>"
KEEP = 0.5
ROUNDS = 25
#: Shares of bad votes, abstentions aside, that the estimation starts from and stays within. A bad
#: text mostly breaks one rule of the nine, so a rule is silent on most of them.
START = {"good": 0.01, "bad": 0.15}
START_GOOD = 0.8
BOUNDS = {"good": (0.001, 0.2), "bad": (0.02, 0.99)}
#: Weight of the start, in documents, against what is counted.
PRIOR_WEIGHT = 20.0
#: Common words of the languages the corpus holds; a running text has some.
STOP_WORDS = ("the of and to in is that it for was with as be by on le la les des et en un une que qui est dans "
              "der die das und ist von mit den zu auf ein eine el los las de y del por con se su").split()
COUNTS = ["n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words"]


def let(value: Column, body) -> Column:
    """``body(value)`` with the value computed once."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def split_words(text: Column) -> Column:
    return let(F.btrim(text, F.lit(SPACE)), lambda t: F.when(t == "", F.array().cast("array<string>")).otherwise(F.split(t, GAP)))


def without(text: Column, characters: str) -> Column:
    return F.length(text) - F.length(F.translate(text, characters, ""))


def repeated_words(words: Column) -> Column:
    """Words inside 5-word windows that occur twice or more, the first occurrence included."""
    windows = F.transform(F.sequence(F.lit(0), F.size(words) - 5), lambda i: F.xxhash64(
        *(F.get(words, i + j) for j in range(5))))

    def covered(window: Column) -> Column:
        by_hash = F.sort_array(F.transform(window, lambda h, i: F.struct(h.alias("h"), i.alias("i"))))

        def places(s: Column) -> Column:
            at = F.sequence(F.lit(0), F.size(s) - 1)
            same = F.filter(at, lambda k: (F.get(s, k)["h"] == F.coalesce(F.get(s, k - 1)["h"], F.bitwise_not(F.get(s, k)["h"])))
                            | (F.get(s, k)["h"] == F.coalesce(F.get(s, k + 1)["h"], F.bitwise_not(F.get(s, k)["h"]))))
            return F.sort_array(F.transform(same, lambda k: F.get(s, k)["i"]))

        def width(p: Column) -> Column:
            return F.aggregate(F.sequence(F.lit(0), F.size(p) - 1), F.lit(0).cast("bigint"),
                               lambda n, k: n + F.least(F.lit(5), F.coalesce(F.get(p, k + 1) - F.get(p, k), F.lit(5))))

        return F.when(F.size(F.array_distinct(window)) == F.size(window), F.lit(0).cast("bigint")).otherwise(
            let(let(by_hash, places), width))

    return F.when(F.size(words) < 6, F.lit(0).cast("bigint")).otherwise(let(windows, covered))


def measured(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` and the counts the rules judge."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    n = lambda c: c.cast("bigint")
    return (docs.select(*keep, text.alias("__t")).withColumn("__w", split_words(F.col("__t"))).select(
        *keep, n(F.size("__w")).alias("n_words"), n(F.length("__t") - without(F.col("__t"), SPACE)).alias("word_chars"),
        n(without(F.col("__t"), SYMBOLS)).alias("n_symbols"), let(F.filter(F.split(F.col("__t"), "\n"), lambda x: F.btrim(x, F.lit(SPACE)) != ""),
            lambda x: F.struct(n(F.size(x)).alias("n"), n(F.size(x) - F.size(F.array_distinct(x))).alias("d"),
                               n(F.size(F.filter(x, lambda s: F.btrim(s, F.lit(SPACE)).rlike("[.!?:;\"')\\]]$")))).alias("e"))).alias("__l"),
        repeated_words(F.col("__w")).alias("n_repeat_words"), n(without(F.col("__t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ")).alias("upper"),
        n(without(F.col("__t"), "0123456789")).alias("digits"),
        n(F.size(F.array_intersect(F.col("__w"), F.array(*map(F.lit, STOP_WORDS))))).alias("stops"))
        .select("*", F.col("__l.n").alias("n_lines"), F.col("__l.d").alias("n_dup_lines"), F.col("__l.e").alias("n_ended")).drop("__l"))


def vote(bad: Column, good: Column) -> Column:
    return F.when(bad, -1).when(good, 1).otherwise(0)


def rules() -> dict[str, Column]:
    """Each rule's vote: -1 bad, 1 good, 0 abstains."""
    words, chars = F.greatest(F.col("n_words"), F.lit(1)), F.greatest(F.col("word_chars"), F.lit(1))
    mean, lines = F.col("word_chars") / words, F.greatest(F.col("n_lines"), F.lit(1))
    return {
        "v_length": vote(F.col("n_words") < 5, F.col("n_words") >= 40),
        "v_mean": vote((mean < 2) | (mean > 14), mean.between(3, 9)),
        "v_symbols": vote(F.col("n_symbols") > 0.1 * words, F.col("n_symbols") <= 0.01 * words),
        "v_lines": vote(F.col("n_dup_lines") > 0.3 * lines, F.col("n_dup_lines") == 0),
        "v_repeats": vote(F.col("n_repeat_words") > 0.2 * words, F.col("n_repeat_words") <= 0.05 * words),
        "v_upper": vote(F.col("upper") > 0.4 * chars, F.col("upper") <= 0.12 * chars),
        "v_stops": vote((F.col("stops") == 0) & (F.col("n_words") >= 20), F.col("stops") >= 3),
        "v_ends": vote((F.col("n_ended") < 0.1 * lines) & (F.col("n_lines") >= 3), F.col("n_ended") >= 0.5 * lines),
        "v_digits": vote(F.col("digits") > 0.3 * chars, F.col("digits") <= 0.05 * chars),
    }


def posterior(model: dict[str, float]) -> Column:
    """Probability of good, from the votes of a row: each counts by how likely it is from a good and from a bad text."""
    odds = F.lit(math.log(model["good"] / (1 - model["good"])))
    for name in rules():
        wrong, right = model[f"{name}_good"], model[f"{name}_bad"]  # a bad vote on a good text, on a bad one
        odds = odds + F.when(F.col(name) == -1, math.log(wrong / right)).when(F.col(name) == 1, math.log((1 - wrong) / (1 - right))).otherwise(0.0)
    return 1 / (1 + F.exp(-odds))


def estimate(votes: DataFrame, scratch: Scratch) -> dict[str, float]:
    """How often each rule votes bad on good and on bad texts, and the share of good ones, by
    expectation-maximisation over the vote patterns."""
    names = list(rules())
    patterns = scratch.keep(votes.groupBy(*names).agg(F.count("*").alias("n")).coalesce(1), "votes")  # 3 ** len(names) rows at most
    model = {"good": START_GOOD, **{f"{n}_{side}": p for n in names for side, p in START.items()}}
    for _ in range(ROUNDS):
        p = posterior(model)
        sums = []
        for n in names:
            for side, weight in (("good", p), ("bad", 1 - p)):
                sums += [F.sum(F.when(F.col(n) == -1, F.col("n") * weight)).alias(f"b_{n}_{side}"),
                         F.sum(F.when(F.col(n) != 0, F.col("n") * weight)).alias(f"c_{n}_{side}")]
        row = patterns.agg(F.sum("n").alias("n"), F.sum(F.col("n") * p).alias("good"), *sums).first()
        if not row["n"]:
            return model
        fresh = {"good": (row["good"] + PRIOR_WEIGHT * START_GOOD) / (row["n"] + PRIOR_WEIGHT)}  # free within (0, 1)
        for n in names:
            for side, start in START.items():
                key = f"{n}_{side}"
                share = ((row[f"b_{key}"] or 0.0) + PRIOR_WEIGHT * start) / ((row[f"c_{key}"] or 0.0) + PRIOR_WEIGHT)
                low, high = BOUNDS[side]
                fresh[key] = min(high, max(low, share))
            fresh[f"{n}_bad"] = max(fresh[f"{n}_bad"], 2 * fresh[f"{n}_good"])  # a rule speaks for its side
        moved = max(abs(fresh[k] - model[k]) for k in model)
        model = fresh
        if moved < 1e-4:
            break
    scratch.drop(patterns)
    return model


def judge(docs: DataFrame, keep: list[str]) -> DataFrame:
    """The columns ``keep`` with the counts, ``base_failed``, ``quality`` and ``kept``."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.keep(measured(docs, keep).select(*keep, *COUNTS, *(c.cast("int").alias(n) for n, c in rules().items())), "counts")
    failed = (F.col("n_words") < 10) | (100 * F.col("n_repeat_words") > 20 * F.col("n_words"))
    model = estimate(rows.filter(~failed), scratch)
    return (rows.withColumn("base_failed", failed).withColumn("quality", posterior(model))
            .select(*keep, *COUNTS, "base_failed", (~F.col("base_failed") & (F.col("quality") >= KEEP)).alias("kept"), "quality"))


@query("op8_quality")
def quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts and verdict of every document."""
    return judge(documents(spark, sf_dir).select(F.col("doc_id").cast("bigint"), "text"), ["doc_id"])
