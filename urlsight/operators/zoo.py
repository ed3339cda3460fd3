"""Class weights and the distributed classifier zoo.

Forests, bagging, first-order boosting and logistic regression are
``pyspark.ml`` estimators; the boosters of their own kind share one binned table
(``binning``, ``boosting``), extremely randomised trees grow in ``extra_trees``.
Two presets: ``reference`` (the reference's settings, the default) and ``smoke``
(at most 10 rounds/trees, for unit tests). The assembled training table is written
once to the shared folder and read by every model.
"""
from __future__ import annotations

import json
import math
import time
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass
from typing import Callable

from pyspark import inheritable_thread_target
from pyspark.ml import Pipeline
from pyspark.ml.classification import GBTClassifier, LogisticRegression, RandomForestClassifier
from pyspark.ml.feature import StandardScaler, VectorAssembler
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import written
from .binning import Binned, binned
from .boosting import BoostedTrees, Booster, Settings, boosted_stumps
from .encode import OTHER, TldVocab, bucket_tld, dummy_names, feature_names, ordered_target, qcol
from .extra_trees import ExtraTrees, ExtraTreesModel
from .metrics import class_metrics_from_counts, confusion_counts, auc_metrics, curve, log_loss

# --- Fixed values that must equal the reference: model settings --------------
POS_WEIGHT = 100000 / 16600  # fixed positive-class weight of the XGBoost-style model
RANDOM_FOREST = dict(numTrees=200, minInstancesPerNode=2, maxDepth=30)
EXTRA_TREES = dict(numTrees=200, minInstancesPerNode=2, maxDepth=30)
XGBOOST = dict(rounds=300, max_depth=8, learning_rate=0.08, row_share=0.9, feature_share=0.9, l2=1.0, least_hessian=1.0)
# rows are drawn only every k-th round, and k is 0 unless set: the row share of 0.9 has no effect
LIGHTGBM = dict(rounds=300, growth="leaf", max_leaves=31, learning_rate=0.08, feature_share=0.9, least_rows=20, least_hessian=1e-3)
CATBOOST = dict(rounds=300, growth="symmetric", max_depth=8, learning_rate=0.08, l2=3.0, from_average=False)
GRADIENT_BOOSTING = dict(maxIter=100, maxDepth=4, stepSize=0.1)
HIST_GRADIENT_BOOSTING = dict(rounds=400, growth="leaf", max_leaves=31, learning_rate=0.05, least_rows=20, least_hessian=1e-3)
ADABOOST = dict(rounds=200, learning_rate=0.5)
BAGGING = dict(numTrees=30, minInstancesPerNode=1, maxDepth=30, featureSubsetStrategy="all")
LOGISTIC_ITERATIONS = 500
SEED = 42
# ---------------------------------------------------------------------------
ROWS_PER_TASK = 50_000   # of a training table


def class_counts(df: DataFrame, label_col: str = "label") -> dict[int, int]:
    """Rows of class 0 and 1 (two rows reach the driver); any other label is an error."""
    rows = df.select(F.when(F.col(label_col).isin(0, 1), F.col(label_col)).cast("int").alias("c")).groupBy("c").count().collect()
    found = {r[0]: int(r[1]) for r in rows}
    if None in found:
        raise ValueError(f"{found[None]} row(s) have a {label_col} other than 0 and 1")
    return found


def balanced_weight(df: DataFrame, label_col: str = "label", counts: dict[int, int] | None = None) -> Column:
    """N / (2 * n_class), as a literal CASE (the class table is tiny)."""
    counts = counts if counts is not None else class_counts(df, label_col)
    total = sum(counts.values())
    expr = None
    for k, n in counts.items():
        w = F.lit(total / (len(counts) * n))
        expr = F.when(F.col(label_col) == k, w) if expr is None else expr.when(F.col(label_col) == k, w)
    return expr if expr is not None else F.lit(1.0)


def pos_weight(label_col: str = "label") -> Column:
    """Fixed positive weight."""
    return F.when(F.col(label_col) == 1, F.lit(POS_WEIGHT)).otherwise(F.lit(1.0))


def with_class_weights(df: DataFrame, label_col: str = "label") -> DataFrame:
    """Both weight columns, from the counts of the two classes."""
    return df.withColumn("w_balanced", balanced_weight(df, label_col)).withColumn("w_pos", pos_weight(label_col))


# ------------------------------------------------------------------ trainers
@dataclass
class Trainer:
    name: str
    build: Callable[[str, str | None], object]   # (preset, weight_col) -> estimator
    weighting: str | None                        # None | 'balanced' | 'pos'
    input: str = "features"                      # 'binned': fits the shared binned table; 'ordered': with TLD statistics instead of dummies


def _small(preset: str, settings: dict) -> dict:
    """The settings, or at most 10 trees/rounds of a small depth for unit tests."""
    if preset != "smoke":
        return settings
    most = {"numTrees": 10, "maxIter": 10, "maxDepth": 5, "max_depth": 5, "rounds": 5}
    return {k: min(v, most[k]) if k in most else v for k, v in settings.items()}


def _rf(preset, w, settings):
    return RandomForestClassifier(seed=SEED, **({"weightCol": w} if w else {}), **_small(preset, settings))


def _gbt(preset, w, settings):
    return GBTClassifier(seed=SEED, checkpointInterval=10, **({"weightCol": w} if w else {}), **_small(preset, settings))


def _booster(preset, settings):
    return Booster(Settings(seed=SEED, **_small(preset, settings)))


def _logistic(preset, w):
    scaler = StandardScaler(inputCol="features", outputCol="scaled", withMean=True, withStd=True)
    kw = dict(featuresCol="scaled", maxIter=10 if preset == "smoke" else LOGISTIC_ITERATIONS, standardization=False, regParam=0.0, tol=1e-12)
    lr = LogisticRegression(weightCol=w, **kw) if w else LogisticRegression(**kw)
    return Pipeline(stages=[scaler, lr])


TRAINERS: dict[str, Trainer] = {
    "RandomForest": Trainer("RandomForest", lambda p, w: _rf(p, w, RANDOM_FOREST), "balanced"),
    "ExtraTrees": Trainer("ExtraTrees", lambda p, w: ExtraTrees(weight_col=w, **_small(p, EXTRA_TREES)), "balanced"),
    "XGBoost": Trainer("XGBoost", lambda p, w: _booster(p, XGBOOST), "pos", "binned"),
    "LightGBM": Trainer("LightGBM", lambda p, w: _booster(p, LIGHTGBM), "balanced", "binned"),
    "CatBoost": Trainer("CatBoost", lambda p, w: _booster(p, CATBOOST), "balanced", "ordered"),
    "GradientBoosting": Trainer("GradientBoosting", lambda p, w: _gbt(p, w, GRADIENT_BOOSTING), None),
    "HistGradientBoosting": Trainer("HistGradientBoosting", lambda p, w: _booster(p, HIST_GRADIENT_BOOSTING), "balanced", "binned"),
    "AdaBoost": Trainer("AdaBoost", lambda p, w: AdaBoostStumps(**_small(p, ADABOOST)), None, "binned"),
    "Bagging": Trainer("Bagging", lambda p, w: _rf(p, w, BAGGING), None),
    "LogisticRegression": Trainer("LogisticRegression", lambda p, w: _logistic(p, w), "balanced"),
}


def internal_names(n: int) -> list[str]:
    """Positional column names used inside the ML pipeline (dots in TLD
    names would be parsed as struct access by ML stages)."""
    return [f"f{i:03d}" for i in range(n)]


def assemble(encoded: DataFrame, feature_names: list[str], keep: list[str]) -> DataFrame:
    """Rename features positionally and assemble the ``features`` vector."""
    names = internal_names(len(feature_names))
    renamed = encoded.select(*keep, *[qcol(f).cast("double").alias(n) for f, n in zip(feature_names, names)])
    va = VectorAssembler(inputCols=names, outputCol="features", handleInvalid="keep")
    return va.transform(renamed)


@dataclass
class FittedModel:
    name: str
    vocab_model: object
    feature_names: list[str]
    model: object
    train_seconds: float
    category: dict[str, float] | None = None     # TLD -> target statistic, where that stands for the dummies
    run: str = ""                                # what it was fitted on and how; a saved model is taken again only for the same

    def design(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """``keep`` and the assembled ``features``."""
        from .encode import encode
        vocab = self.vocab_model.getVocabulary()
        if self.category is None:
            return assemble(encode(df, vocab, numeric=numeric_of(self.feature_names, vocab), keep=keep), self.feature_names, keep)
        numeric = self.feature_names[:-1]
        known = F.create_map(*[F.lit(v) for pair in self.category.items() for v in pair])
        stat = known[bucket_tld(F.col("tld"), vocab)] if "tld" in df.columns else F.lit(self.category[OTHER])
        cols = [F.coalesce(F.col(c), F.lit(0)).alias(c) if c in df.columns else F.lit(0).alias(c) for c in numeric]
        return assemble(df.select(*keep, *cols, stat.alias(CATEGORY)), self.feature_names, keep)

    def score(self, df: DataFrame, keep: list[str]) -> DataFrame:
        """V1/V2/V4: encode -> assemble -> model -> ``p``, ``margin`` and the model's ``prediction``."""
        from .score import class_scores
        return class_scores(self.model.transform(self.design(df, keep))).select(*keep, "p", "margin", "prediction")


CATEGORY = "tld_target"


def prepare(train: DataFrame, top_n: int = 50, numeric: list[str] | None = None):
    """Fit the TLD vocabulary on the training rows (N1 on the train split).

    ``numeric``: the numeric columns to learn from (P5), the 22 URL features by default.
    """
    vocab_model = TldVocab(topN=top_n).fit(train)
    return vocab_model, feature_names(vocab_model.getVocabulary(), numeric)


def numeric_of(names: list[str], vocab: list[str]) -> list[str]:
    """The numeric part of a feature order."""
    return names[:len(names) - len(dummy_names(vocab))]


def training_table(train: DataFrame, vocab_model, names: list[str], label_col: str = "label") -> DataFrame:
    """The encoded, assembled training rows, written once: ``(label, features)``.

    Iterative trainers scan it many times; a small table is read by few tasks,
    since each pass costs a job.
    """
    from .encode import encode
    vocab = vocab_model.getVocabulary()
    enc = encode(train, vocab, numeric=numeric_of(names, vocab), keep=[label_col])
    return sized(written(assemble(enc, names, [label_col]).select(F.col(label_col).cast("double").alias("label"), "features")))


def sized(table: DataFrame) -> DataFrame:
    """A written table in one task for every ``ROWS_PER_TASK`` rows at most."""
    return table.coalesce(max(1, math.ceil(table.count() / ROWS_PER_TASK)))


def ordered_table(train: DataFrame, vocab_model, names: list[str], label_col: str = "label") -> tuple[DataFrame, list[str], dict[str, float]]:
    """The training rows with the ordered target statistic of their TLD instead of dummies, its feature names and the statistics for new rows."""
    vocab = vocab_model.getVocabulary()
    numeric = numeric_of(names, vocab)
    tld = bucket_tld(F.col("tld"), vocab) if "tld" in train.columns else F.lit(OTHER)
    cols = [F.coalesce(F.col(c), F.lit(0)).alias(c) if c in train.columns else F.lit(0).alias(c) for c in numeric]
    rows = written(train.select(F.col(label_col).cast("double").alias("label"), tld.alias("tld"), *cols, F.monotonically_increasing_id().alias("row")))
    coded, stats = ordered_target(rows, "tld", "label", "row", CATEGORY)
    known = {r["tld"]: r[CATEGORY] for r in stats.collect()}     # the vocabulary's buckets
    known.setdefault(OTHER, sum(known.values()) / len(known))
    for t in vocab:
        known.setdefault(t, known[OTHER])
    # the bins' edges and codes read it in turn: the prefix sums run once
    return written(assemble(coded, [*numeric, CATEGORY], ["label"]).select("label", "features")), [*numeric, CATEGORY], known


def fit_one(trainer: Trainer, train: DataFrame, vocab_model, names: list[str], preset: str = "reference",
            label_col: str = "label", assembled: DataFrame | None = None, shared: Binned | None = None) -> FittedModel:
    """Fit one model; the wall time covers ``fit`` only (as in the reference).

    ``assembled`` is a training table made before, ``shared`` its binned form.
    """
    data = training_table(train, vocab_model, names, label_col) if assembled is None else assembled
    counts = class_counts(data, "label")
    total, category = sum(counts.values()), None
    class_weights = {"balanced": tuple(total / (len(counts) * counts[c]) if c in counts else 1.0 for c in (0, 1)),
                     "pos": (1.0, POS_WEIGHT)}.get(trainer.weighting, (1.0, 1.0))
    w = None if trainer.weighting is None else "weight"
    if w and trainer.input == "features":
        data = data.withColumn("weight", balanced_weight(data, "label", counts) if trainer.weighting == "balanced" else pos_weight("label"))
    est = trainer.build(preset, w)
    if trainer.name == "LogisticRegression":
        # sklearn's default L2 (C=1) on the weighted loss sum equals regParam = 1 / sum(w)
        total_w = sum(class_weights[c] * n for c, n in counts.items())
        est.getStages()[1].setRegParam(1.0 / max(total_w, 1))
    t0 = time.time()
    if trainer.input == "features":
        model = est.fit(data)
    else:
        if trainer.input == "ordered":
            data, names, category = ordered_table(train, vocab_model, names, label_col)
        model = est.fit(shared if shared is not None and trainer.input == "binned" else binned(data), class_weights)
    return FittedModel(trainer.name, vocab_model, names, model, time.time() - t0, category)


def scored_rows(fitted: FittedModel, test: DataFrame, label_col: str = "label") -> DataFrame:
    """A3 rows of one model on the test rows: the class is the model's own prediction.

    A model without probabilities is ranked by its margin (``has_p`` false).
    """
    return fitted.score(test, [label_col]).select(
        F.lit(fitted.name).alias("model"), F.col(label_col).cast("int").alias("y"), F.coalesce("p", "margin").alias("p"),
        F.col("prediction").cast("int").alias("yhat"), F.col("p").isNotNull().alias("has_p"))


def evaluate_scored(scored: DataFrame, train_seconds: dict[str, float]) -> DataFrame:
    """V16 for scored rows of any number of models, with their train seconds; log loss NULL without probabilities."""
    spark = scored.sparkSession
    seconds = spark.createDataFrame([(k, round(v, 2)) for k, v in train_seconds.items()], "model string, train_seconds double")
    cm = class_metrics_from_counts(confusion_counts(scored))
    auc = auc_metrics(curve(scored))
    ll = log_loss(scored.where("has_p"))
    return cm.join(auc, "model").join(ll, "model", "left").join(seconds, "model").select(
        "model", "accuracy", "precision_phish", "recall_phish", "f1_phish", "roc_auc", "pr_auc", "mcc", "log_loss",
        "tp", "fp", "tn", "fn", "train_seconds")


def evaluate(fitted: FittedModel, test: DataFrame, label_col: str = "label") -> DataFrame:
    """V16 for one fitted model: metric row + train seconds. The test rows are scored once."""
    return evaluate_scored(written(scored_rows(fitted, test, label_col)), {fitted.name: fitted.train_seconds})


class ModelsFailed(RuntimeError):
    """Models that were asked for could not be fitted; the message holds each one's error."""


class EveryModelFailed(ModelsFailed):
    """No model could be fitted."""


AT_ONCE = 6      # models that are fitted at the same time


def train_all(train: DataFrame, test: DataFrame, names: list[str] | None = None, preset: str = "reference",
              label_col: str = "label", numeric: list[str] | None = None, save_dir: str | None = None, at_once: int = AT_ONCE,
              skip_failed: bool = True):
    """Fit every trainer on one written table and its binned form, score the test rows of each once.

    ``at_once`` models are fitted at the same time, each in a thread with a scheduler
    pool of its own (shares are fair where the session's scheduler is). With ``save_dir`` every model is
    saved when it is done, and a later run on the same rows and settings takes it from there. A
    failing model is skipped and reported with its error (reference behaviour); if all
    fail, or any does and ``skip_failed`` is false, that is an error. Returns the fitted models, the written scored rows of all of them, the metric
    rows and the failures.
    """
    from functools import reduce
    spark = train.sparkSession
    vocab_model, feat_names = prepare(train, numeric=numeric)
    data = training_table(train, vocab_model, feat_names, label_col)
    names = names or list(TRAINERS)
    shared = binned(data) if any(TRAINERS[n].input == "binned" for n in names) else None
    run = f"{preset}, {len(feat_names)} features, {sorted(class_counts(data).items())}, {data.agg(F.sum(F.xxhash64('label', 'features').cast('decimal(38,0)'))).first()[0]}"

    def fit(name: str) -> FittedModel:
        from ..sources import io
        spark.sparkContext.setLocalProperty("spark.scheduler.pool", name)
        if save_dir and io.path_exists(spark, f"{save_dir}/{name}/meta"):
            saved = io.load_model(spark, f"{save_dir}/{name}")
            if saved.run == run:
                return saved
        fm = fit_one(TRAINERS[name], train, vocab_model, feat_names, preset, label_col, data, shared)
        fm.run = run
        if save_dir:
            io.save_model(fm, f"{save_dir}/{name}")
        return fm

    fitted, failures = {}, {}
    with ThreadPoolExecutor(max_workers=at_once) as pool:
        waiting = {name: pool.submit(inheritable_thread_target(spark)(fit), name) for name in names}
        for name, done in waiting.items():
            try:
                fitted[name] = done.result()
            except Exception as exc:  # per-model failure isolation
                failures[name] = f"{type(exc).__name__}: {exc}"[:500]
    if not fitted or (failures and not skip_failed):
        raise (ModelsFailed if fitted else EveryModelFailed)("; ".join(f"{n}: {e}" for n, e in failures.items()))
    scored = written(reduce(DataFrame.unionByName, [scored_rows(fm, test, label_col) for fm in fitted.values()]))
    return fitted, scored, evaluate_scored(scored, {n: fm.train_seconds for n, fm in fitted.items()}), failures


# ------------------------------------------------------------------ AdaBoost
class AdaBoostStumps:
    """M8: discrete AdaBoost (SAMME, two classes) over stumps of the binned table, one weighted aggregate a round."""

    def __init__(self, rounds: int, learning_rate: float):
        self.rounds = rounds
        self.learning_rate = learning_rate

    def fit(self, data: DataFrame | Binned, class_weights: tuple[float, float] = (1.0, 1.0)) -> "AdaBoostModel":
        data = data if isinstance(data, Binned) else binned(data)
        return AdaBoostModel(boosted_stumps(data, self.rounds, self.learning_rate, class_weights))


def _stump_table(stumps: list[tuple]) -> Column:
    """The stumps as one constant (parsed once by constant folding, whatever their number)."""
    rows = [{"i": int(i), "thr": min(float(thr), 1e308), "left": left, "right": right, "alpha": alpha}
            for (i, thr, left, right), alpha in stumps]
    return F.from_json(F.lit(json.dumps(rows)), "array<struct<i:int,thr:double,left:double,right:double,alpha:double>>")


def _over_stumps(stumps: list[tuple], features: Column, step) -> Column:
    """Fold ``step(sum, stump, predicted class)`` over the stumps; the vector is converted once a row."""
    def fold(x: Column) -> Column:
        return F.aggregate(_stump_table(stumps), F.lit(0.0), lambda acc, s: step(
            acc, s, F.when(F.get(x, s["i"]) <= s["thr"], s["left"]).otherwise(s["right"])))
    return F.get(F.transform(F.array(vector_to_array(features)), fold), F.lit(0))


class AdaBoostModel:
    def __init__(self, stumps: list[tuple]):
        self.stumps = stumps

    def transform(self, df: DataFrame) -> DataFrame:
        total = sum(a for _, a in self.stumps) or 1.0
        votes = _over_stumps(self.stumps, F.col("features"), lambda acc, s, p: acc + s["alpha"] * (p * 2 - 1))
        p1 = 1 / (1 + F.exp(-votes / F.lit(total)))
        return df.withColumn("__p1", p1).withColumn("probability", array_to_vector(F.array(1 - F.col("__p1"), F.col("__p1")))).withColumn(
            "prediction", (F.col("__p1") > 0.5).cast("double")).drop("__p1")


def loss_curve(spark: SparkSession, model) -> DataFrame:
    """The training log loss after each tree of a boosted model."""
    return spark.createDataFrame([(i + 1, float(v)) for i, v in enumerate(model.losses)], "iteration int, log_loss double")
