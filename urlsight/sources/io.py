"""Sources and sinks (S2-S4, S6-S14): CSV/parquet/JSON readers and writers,
model and artifact persistence. All writers are distributed DataFrame
writes; nothing is collected to the driver.
"""
from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

CORRUPT_COL = "_corrupt_record"


class MissingColumnError(ValueError):
    """S3: a required input column is absent."""


# --- Fixed values: numeric columns of a labelled table (others are text).
INTEGER_COLUMNS = ["url_len", "dom_len", "is_ip", "tld_len", "subdom_cnt", "letter_cnt", "digit_cnt", "special_cnt", "eq_cnt", "qm_cnt",
                   "amp_cnt", "dot_cnt", "dash_cnt", "under_cnt", "is_https", "slash_cnt", "path_len", "query_len", "label"]
DOUBLE_COLUMNS = ["letter_ratio", "digit_ratio", "spec_ratio", "entropy"]


def read_csv(spark: SparkSession, path: str, schema: str | None = None) -> DataFrame:
    """CSV with header; malformed lines (also those with missing or
    surplus fields) are kept with their raw text in ``_corrupt_record``.

    Without a schema the header names the columns: those of a labelled URL
    table are typed, all others are text.
    """
    reader = spark.read.option("header", True)
    if schema is None:
        types = dict.fromkeys(INTEGER_COLUMNS, "int") | dict.fromkeys(DOUBLE_COLUMNS, "double")
        names = reader.csv(path).columns  # reads the header only
        schema = ", ".join(f"`{n}` {types.get(n, 'string')}" for n in names)
    if CORRUPT_COL not in schema:
        schema = f"{schema}, {CORRUPT_COL} string"
    return (reader.option("mode", "PERMISSIVE").option("multiLine", False).option("columnNameOfCorruptRecord", CORRUPT_COL)
            .schema(schema).csv(path))


def kind_of(path: str, given: str | None = None) -> str:
    """File kind of an input: as given, or by the path's suffix (parquet unless it says csv or json)."""
    if given:
        return given
    tail = path.rstrip("/").lower()
    return next((k for k in ("csv", "json") if tail.endswith((f".{k}", f"/{k}"))), "parquet")


def read_input(spark: SparkSession, path: str, kind: str | None = None) -> DataFrame:
    """Any job's input table."""
    kind = kind_of(path, kind)
    return read_csv(spark, path) if kind == "csv" else spark.read.format(kind).load(path)


def split_corrupt(df: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """Good rows without the corrupt-record column, and the malformed ones (None if the input has no such column)."""
    if CORRUPT_COL not in df.columns:
        return df, None
    bad = F.col(CORRUPT_COL).isNotNull()
    return df.where(~bad).drop(CORRUPT_COL), df.where(bad)


def require_columns(df: DataFrame, required: list[str]) -> DataFrame:
    """S3: fail before planning, naming the columns that were found."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise MissingColumnError(f"missing column(s) {missing}; found columns: {df.columns}")
    return df


def read_urls(spark: SparkSession, path: str, fmt: str | None = "csv") -> DataFrame:
    """A2 batch-scoring input: any columns, ``url`` required."""
    return require_columns(read_input(spark, path, fmt), ["url"])


# --- Fixed values: the sample input template (5 URLs) offered to batch users.
SAMPLE_TEMPLATE_URLS = [
    "https://www.google.com/",
    "http://paypal-secure-login.com/account/verify?id=123",
    "https://github.com/",
    "http://192.168.1.1/admin/login.php",
    "https://en.wikipedia.org/wiki/Phishing",
]


def write_sample_template(spark: SparkSession, path: str) -> None:
    """A one-column CSV template for the batch scorer."""
    spark.createDataFrame([(u,) for u in SAMPLE_TEMPLATE_URLS], "url string") \
        .coalesce(1).write.mode("overwrite").option("header", True).csv(path)


def write_table(df: DataFrame, path: str, fmt: str = "parquet", partition_by: list[str] | None = None) -> None:
    """Distributed write (csv gets a header)."""
    w = df.write.mode("overwrite")
    if partition_by:
        w = w.partitionBy(*partition_by)
    if fmt == "csv":
        w = w.option("header", True)
    w.format(fmt).save(path)


def write_predictions(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """All input columns + verdict/probability/risk_score; the verdict is
    exported under the reference's column name ``label``."""
    out = df.withColumnRenamed("verdict", "label") if "verdict" in df.columns and "label" not in df.columns else df
    write_table(out, path, fmt)


def write_metrics(metrics: DataFrame, out_dir: str) -> None:
    """Metric table as CSV and as JSON records."""
    write_table(metrics.coalesce(1), f"{out_dir}/model_comparison_csv", "csv")
    write_table(metrics.coalesce(1), f"{out_dir}/model_comparison_json", "json")


def write_roc(points: DataFrame, metrics: DataFrame, out_dir: str) -> None:
    """ROC points with each model's area, one folder per model."""
    points = points.join(metrics.select("model", "roc_auc"), "model")
    write_table(points, f"{out_dir}/roc_curves", "parquet", ["model"])


def write_confusion(cells: DataFrame, out_dir: str) -> None:
    """Confusion cells long table."""
    write_table(cells, f"{out_dir}/confusion", "parquet")


def write_best_meta(metrics: DataFrame, feature_names: list[str], n_train: int, n_test: int, out_dir: str) -> None:
    """Best model name, its metrics, the feature order and row counts, as one JSON row."""
    from ..operators.metrics import rank_models
    best = rank_models(metrics).where(F.col("rank") == 1).drop("rank", "is_best")
    meta = best.select(F.col("model").alias("best_model"), F.struct(*[c for c in best.columns if c != "model"])
                       .alias("metrics"),
                       F.array(*[F.lit(n) for n in feature_names]).alias("feature_columns"),
                       F.lit(len(feature_names)).alias("n_features"), F.lit(n_train).alias("n_train"),
                       F.lit(n_test).alias("n_test"))
    write_table(meta.coalesce(1), f"{out_dir}/best_meta", "json")


def read_artifact(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame | None:
    """Read an artifact; ``None`` when it does not exist (callers
    show a message instead of failing, like the reference's UI)."""
    if not path_exists(spark, path):
        return None
    if fmt == "csv":
        return spark.read.option("header", True).option("inferSchema", True).csv(path)
    return spark.read.format(fmt).load(path)


def path_exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(conf).exists(p)


# -------------------------------------------------------------- models
def save_model(fitted, path: str) -> None:
    """One folder per model: TLD vocabulary, the model, metadata (written last, so it tells that all is there)."""
    from ..operators.zoo import AdaBoostModel, BoostedTrees, ExtraTreesModel
    spark = SparkSession.builder.getOrCreate()      # models are fitted in threads, which have no active session
    fitted.vocab_model.write().overwrite().save(f"{path}/vocab")
    kind = type(fitted.model).__name__
    if isinstance(fitted.model, AdaBoostModel):
        spark.createDataFrame([(i, s[0], s[1], s[2], s[3], float(a)) for i, (s, a) in enumerate(fitted.model.stumps)],
                              "i int, feature int, threshold double, left double, right double, alpha double") \
            .coalesce(1).write.mode("overwrite").parquet(f"{path}/model")
    elif isinstance(fitted.model, (BoostedTrees, ExtraTreesModel)):
        spark.createDataFrame(list(enumerate(fitted.model.to_json())), "i int, part string").write.mode("overwrite").parquet(f"{path}/model")
    else:
        fitted.model.write().overwrite().save(f"{path}/model")
    meta = {"name": fitted.name, "kind": kind, "feature_names": fitted.feature_names, "train_seconds": fitted.train_seconds,
            "model_class": type(fitted.model).__module__ + "." + kind, "category": fitted.category, "run": fitted.run}
    spark.createDataFrame([(json.dumps(meta),)], "meta string").coalesce(1).write.mode("overwrite").text(
        f"{path}/meta")


def load_model(spark: SparkSession, path: str):
    """Inverse of :func:`save_model`."""
    import importlib

    from ..operators.encode import TldVocabModel
    from ..operators.zoo import AdaBoostModel, BoostedTrees, ExtraTreesModel, FittedModel
    meta = json.loads(spark.read.text(f"{path}/meta").first()[0])
    vocab = TldVocabModel.load(f"{path}/vocab")
    own = {c.__name__: c for c in (BoostedTrees, ExtraTreesModel)}
    if meta["kind"] == "AdaBoostModel":
        rows = spark.read.parquet(f"{path}/model").orderBy("i").collect()  # one row per boosting round
        model = AdaBoostModel([((r["feature"], r["threshold"], r["left"], r["right"]), r["alpha"]) for r in rows])
    elif meta["kind"] in own:
        rows = spark.read.parquet(f"{path}/model").orderBy("i").collect()  # one row per tree
        model = own[meta["kind"]].from_json([r["part"] for r in rows])
    else:
        mod, _, cls = meta["model_class"].rpartition(".")
        model = getattr(importlib.import_module(mod), cls).load(f"{path}/model")
    return FittedModel(meta["name"], vocab, meta["feature_names"], model, meta["train_seconds"], meta.get("category"), meta.get("run", ""))
