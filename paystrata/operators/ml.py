"""Feature vectors, classifier, clustering and isolation forest."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.ml import Model
from pyspark.ml.classification import RandomForestClassificationModel, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from paystrata.functions.classify import category
from paystrata.functions.parse import _col, flag_if
from paystrata.operators import clusters
from paystrata.operators.dedup import top_per_group

# Model parameters.
SEED = 42
TREES = 100
CONTAMINATION = 0.03
CLUSTERS = 3
RESTARTS = 10
SUBSAMPLE = 256
CLASSIFIER_FEATURES = ["amount", "text_length", "has_upi", "has_bank", "has_crypto"]
ANOMALY_FEATURES = ["amount", "type_num", "status_num"]
CLUSTER_FEATURES = ["amount", "text_length"]
EULER_GAMMA = 0.5772156649015329
TEST_DIGITS = ["0", "1", "2"]


def classifier_features(silver: DataFrame) -> DataFrame:
    labelled = silver if "category" in silver.columns else silver.withColumn(
        "category", category("has_crypto", "has_bank"))
    return VectorAssembler(inputCols=CLASSIFIER_FEATURES, outputCol="features").transform(labelled)


def anomaly_features(silver: DataFrame) -> DataFrame:
    return silver.withColumns({
        "type_num": flag_if("type", "DEPOSIT"), "status_num": flag_if("status", "SUCCESS")})


def split(df: DataFrame, key: str = "ref_number") -> tuple[DataFrame, DataFrame]:
    """About four fifths to train, one fifth to test, by the key's md5: the same rows on
    every run, partitioning and engine."""
    test = F.substring(F.md5(F.col(key).cast("binary")), 1, 1).isin(*TEST_DIGITS)
    return df.filter(~test), df.filter(test)


def train_classifier(train: DataFrame, label: str = "category", trees: int = TREES) -> RandomForestClassificationModel:
    return RandomForestClassifier(labelCol=label, featuresCol="features", numTrees=trees, seed=SEED).fit(train)


def class_report(pred: DataFrame, label: str = "category", prediction: str = "prediction") -> DataFrame:
    """Precision, recall, F1 and support per class; zero where undefined."""
    confusion = pred.groupBy(F.col(label).cast("int").alias("actual"),
                             F.col(prediction).cast("int").alias("predicted")).agg(F.count(F.lit(1)).alias("n"))
    entries = F.array(F.struct(F.col("actual").alias("class"), F.lit("a").alias("side")),
                      F.struct(F.col("predicted").alias("class"), F.lit("p").alias("side")))
    sides = confusion.withColumn("e", F.explode(entries))
    hit = F.col("actual") == F.col("predicted")
    totals = sides.groupBy(F.col("e.class").alias("class")).agg(
        F.sum(F.when((F.col("e.side") == "a") & hit, F.col("n")).otherwise(0)).alias("tp"),
        F.sum(F.when(F.col("e.side") == "a", F.col("n")).otherwise(0)).alias("support"),
        F.sum(F.when(F.col("e.side") == "p", F.col("n")).otherwise(0)).alias("predicted"))
    ratio = lambda a, b: F.when(b > 0, a / b).otherwise(0.0)
    return totals.withColumns({
        "precision": ratio(F.col("tp"), F.col("predicted")), "recall": ratio(F.col("tp"), F.col("support")),
    }).withColumn("f1", ratio(2 * F.col("precision") * F.col("recall"), F.col("precision") + F.col("recall"))
                  ).select("class", "precision", "recall", "f1", "support")


def report_averages(report: DataFrame) -> DataFrame:
    """Accuracy, macro and support-weighted averages of a class report, one row."""
    n = F.sum("support")
    macro = [F.avg(c).alias(f"macro_{c}") for c in ("precision", "recall", "f1")]
    weighted = [(F.sum(F.col(c) * F.col("support")) / n).alias(f"weighted_{c}") for c in ("precision", "recall", "f1")]
    return report.agg((F.sum(F.col("recall") * F.col("support")) / n).alias("accuracy"), *macro, *weighted, n.alias("support"))


def train_kmeans(df: DataFrame, k: int = CLUSTERS, restarts: int = RESTARTS, seed: int = SEED,
                 columns: list[str] | None = None) -> tuple[clusters.Clusters, float]:
    """Best of ``restarts`` seeds by inertia; all of them are fitted by the same passes."""
    best = clusters.fit(df, columns or CLUSTER_FEATURES, k, restarts, seed)
    return best, best.inertia


# ------------------------------------------------------------ isolation forest

def _path_bound(n: np.ndarray | float) -> np.ndarray:
    """Mean depth of an unsuccessful search among ``n`` points (published formula)."""
    n = np.asarray(n, dtype="float64")
    bound = np.zeros_like(n)
    many = n > 2
    bound[many] = 2.0 * (np.log(n[many] - 1.0) + EULER_GAMMA) - 2.0 * (n[many] - 1.0) / n[many]
    bound[n == 2] = 1.0
    return bound


_TREE_SCHEMA = ("tree int, feature array<int>, cut array<double>, left array<int>, right array<int>, "
                "path array<double>")


_SETTINGS_SCHEMA = ("features array<string>, trees int, subsample int, contamination double, seed int, "
                    "sample_size int, threshold double")
#: Rows drawn for a tree, as a multiple of what it keeps.
SURPLUS = 2


def _grow(points: np.ndarray, rng: np.random.RandomState) -> dict[str, list]:
    """One random tree as parallel arrays; ``path`` is the depth credited to a leaf."""
    limit = int(np.ceil(np.log2(max(len(points), 2))))
    tree: dict[str, list] = {"feature": [], "cut": [], "left": [], "right": [], "path": []}

    def add(rows: np.ndarray, depth: int) -> int:
        at = len(tree["feature"])
        for name, value in (("feature", -1), ("cut", 0.0), ("left", -1), ("right", -1), ("path", 0.0)):
            tree[name].append(value)
        low, high = rows.min(axis=0), rows.max(axis=0)
        varied = np.flatnonzero(high > low)
        if depth >= limit or len(rows) < 2 or len(varied) == 0:
            tree["path"][at] = float(depth + _path_bound(np.array([len(rows)]))[0])
            return at
        feature = int(rng.choice(varied))
        cut = float(rng.uniform(low[feature], high[feature]))
        below = rows[:, feature] <= cut
        tree["feature"][at], tree["cut"][at] = feature, cut
        tree["left"][at] = add(rows[below], depth + 1)
        tree["right"][at] = add(rows[~below], depth + 1)
        return at

    add(points, 0)
    return tree


class IsolationForest:
    """Isolation forest (Liu, Ting and Zhou, 2008) over columns of a DataFrame.

    Trees grow on small samples, each in its own task. Their size depends on the
    sample, not on the data, so the fitted forest is a small constant and scoring
    is one map over the rows.
    """

    def __init__(self, features: list[str] | None = None, trees: int = TREES, subsample: int = SUBSAMPLE,
                 contamination: float = CONTAMINATION, seed: int = SEED):
        self.features = features or ANOMALY_FEATURES
        self.trees, self.subsample, self.contamination, self.seed = trees, subsample, contamination, seed
        self.forest: list[dict] = []
        self.sample_size = 0
        self.threshold: float | None = None

    def _known(self) -> Column:
        """All features are numbers: a row that lacks one cannot be placed in a tree."""
        known = F.lit(True)
        for f in self.features:
            value = F.col(f).cast("double")
            known = known & value.isNotNull() & ~F.isnan(value)
        return known

    def _sample(self, df: DataFrame, key: str) -> DataFrame:
        """``subsample`` rows per tree, drawn from all rows in one pass.

        With n rows a row goes into about ``SURPLUS * subsample * trees / n`` trees, the
        first picked by its hash and the others next to it; each tree then keeps the
        ``subsample`` rows with the lowest hash, which are cut on the map side.
        """
        rows = df.filter(self._known()).select(
            F.col(key).cast("string").alias("__key"), *[F.col(f).cast("double").alias(f) for f in self.features])
        size = rows.count()
        self.sample_size = min(self.subsample, size)
        wanted = SURPLUS * self.subsample * self.trees / max(size, 1)
        copies = max(1, min(self.trees, int(np.ceil(wanted))))
        pick = F.xxhash64("__key", F.lit(self.seed))
        chance = F.pmod(F.xxhash64("__key", "copy", F.lit(self.seed)), F.lit(1 << 30)) / float(1 << 30)
        trees = (rows.withColumn("copy", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))))
                 .filter(chance < min(1.0, wanted / copies))
                 .withColumn("tree", F.pmod(F.shiftright(pick, 2) + F.col("copy"), F.lit(self.trees)).cast("int")).drop("copy"))
        draw = F.xxhash64("__key", "tree", F.lit(self.seed))
        return top_per_group(trees, ["tree"], [draw, F.col("__key")], self.subsample)

    def fit(self, df: DataFrame, key: str = "ref_number") -> "IsolationForest":
        features, seed = self.features, self.seed

        def grow(pdf: pd.DataFrame) -> pd.DataFrame:
            number = int(pdf["tree"].iloc[0])
            points = pdf.sort_values("rank")[features].to_numpy("float64")
            tree = _grow(points, np.random.RandomState(seed + number))
            return pd.DataFrame({"tree": [number], **{name: [values] for name, values in tree.items()}})

        # Few rows but much work each: a stated partition count keeps adaptive
        # execution from folding the trees into one task.
        sample = self._sample(df, key).repartition(self.trees, "tree")
        rows = sample.groupBy("tree").applyInPandas(grow, _TREE_SCHEMA).orderBy("tree").collect()
        self.forest = [{c: np.array(r[c]) for c in ("feature", "cut", "left", "right", "path")} for r in rows]
        # The cut is the (1 - contamination) point of the training scores. The
        # quantile sketch is bounded; its rank error is below one in 100,000.
        self.threshold = self.score(df).agg(
            F.percentile_approx("anomaly_score", 1.0 - self.contamination, 100000)).first()[0]
        return self

    def score(self, df: DataFrame) -> DataFrame:
        """Adds ``anomaly_score`` in (0, 1]; higher is more anomalous."""
        forest = df.sparkSession.sparkContext.broadcast(self.forest)
        bound = float(_path_bound(np.array([max(self.sample_size, 2)]))[0])
        sample_size = self.sample_size

        def score(batches: Iterator[tuple[pd.Series, ...]]) -> Iterator[pd.Series]:
            # A leaf points to itself, so every row takes the same number of steps.
            trees = []
            for t in forest.value:
                leaf, own = t["feature"] < 0, np.arange(len(t["feature"]))
                trees.append((np.where(leaf, 0, t["feature"]), t["cut"], np.where(leaf, own, t["left"]),
                              np.where(leaf, own, t["right"]), t["path"]))
            steps = int(np.ceil(np.log2(max(sample_size, 2))))
            for columns in batches:
                points = np.column_stack([c.to_numpy("float64") for c in columns])
                flat, start = points.ravel(), np.arange(len(points)) * points.shape[1]
                total = np.zeros(len(points))
                for feature, cut, left, right, path in trees:
                    at = np.zeros(len(points), dtype="int64")
                    for _ in range(steps):
                        below = flat.take(start + feature.take(at)) <= cut.take(at)
                        at = np.where(below, left.take(at), right.take(at))
                    total += path.take(at)
                result = 2.0 ** (-(total / max(len(trees), 1)) / bound)
                yield pd.Series(np.where(np.isnan(points).any(axis=1), np.nan, result))

        scorer = F.pandas_udf(score, "double")
        return df.withColumn("anomaly_score", F.when(
            self._known(), scorer(*[F.coalesce(F.col(f).cast("double"), F.lit(0.0)) for f in self.features])))

    def transform(self, df: DataFrame) -> DataFrame:
        """Adds the score and ``prediction``: -1 anomalous, 1 normal. A row that lacks a
        feature has no score and is predicted normal."""
        return self.score(df).withColumn(
            "prediction", F.when(F.col("anomaly_score") > F.lit(self.threshold), -1).otherwise(1))


    def save(self, spark, path: str) -> None:
        """The forest as two small tables: ``trees`` and ``settings``."""
        rows = [(i, *(t[c].tolist() for c in ("feature", "cut", "left", "right", "path"))) for i, t in enumerate(self.forest)]
        spark.createDataFrame(rows, _TREE_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/trees")
        settings = (self.features, self.trees, self.subsample, self.contamination, self.seed, self.sample_size, self.threshold)
        spark.createDataFrame([settings], _SETTINGS_SCHEMA).coalesce(1).write.mode("overwrite").parquet(f"{path}/settings")

    @classmethod
    def load(cls, spark, path: str) -> "IsolationForest":
        """A forest that scores new rows as the saved one does."""
        s = spark.read.parquet(f"{path}/settings").first()
        out = cls(list(s.features), s.trees, s.subsample, s.contamination, s.seed)
        out.sample_size, out.threshold = s.sample_size, s.threshold
        out.forest = [{c: np.array(r[c]) for c in ("feature", "cut", "left", "right", "path")}
                      for r in spark.read.parquet(f"{path}/trees").orderBy("tree").collect()]
        return out


def anomaly_rate(pred: DataFrame) -> DataFrame:
    flagged = F.count_if(F.col("prediction") == -1)
    return pred.agg(flagged.alias("flagged"), F.count(F.lit(1)).alias("records"),
                    (flagged / F.greatest(F.count(F.lit(1)), F.lit(1)) * 100).alias("flagged_pct"))


# ------------------------------------------------------------------- registry

def save_model(model: Model, path: str) -> None:
    model.write().overwrite().save(path)


def run_metadata(spark, experiment: str, metrics: dict[str, float], models: list[str]) -> DataFrame:
    """One row per run: metrics and the registered models."""
    return spark.range(1).select(
        F.lit(experiment).alias("experiment_name"), F.uuid().alias("run_id"),
        F.current_timestamp().alias("timestamp"),
        F.create_map(*[x for k, v in metrics.items() for x in (F.lit(k), F.lit(float(v)))]).alias("metrics"),
        F.array(*[F.struct(F.lit(m).alias("name"), F.lit("1.0").alias("version"), F.lit("Production").alias("stage"))
                  for m in models]).alias("registered_models"))
