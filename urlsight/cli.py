"""Command-line jobs: features, train, score, eda, report (S4: inputs are explicit arguments).

    python -m urlsight.cli features --input urls.csv --output out/
    python -m urlsight.cli train --input labelled.csv --output-dir run/
    python -m urlsight.cli score --input urls.csv --model-dir run/models/best --output preds/
    python -m urlsight.cli eda --input labelled.parquet --output-dir eda/
    python -m urlsight.cli report --input run/metrics --output-dir report/

The session is whatever Spark is configured for (``spark-submit``, spark-defaults);
``--master`` names one explicitly, e.g. ``--master local[8]``.
"""
from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql import functions as F


def _read(spark, a, rejected: str):
    """The input's good rows; malformed lines of a CSV file are written to ``rejected``."""
    from .sources import io
    df, bad = io.split_corrupt(io.read_input(spark, a.input, a.input_format))
    if bad is not None:
        io.write_table(bad, rejected)
        print(f"{spark.read.parquet(rejected).count()} malformed line(s) in {a.input}, see {rejected}")
    return df


def cmd_features(spark, a):
    from .functions.url import with_url_features
    from .sources import io
    df = io.require_columns(_read(spark, a, f"{a.output.rstrip('/')}_rejected"), [a.url_col])
    io.write_table(with_url_features(df, a.url_col, quality_columns=True), a.output, a.format)


def cmd_train(spark, a):
    from .functions.url import NUMERIC_FEATURES, with_url_features
    from .operators import metrics as M
    from .operators import split as K
    from .operators import zoo as Z
    from .operators.attribution import permutation_importance
    from .operators.coalitions import BACKGROUND_ROWS, coalition_attribution, model_score
    from .operators.encode import numeric_feature_columns
    from .sources import io

    out = a.output_dir.rstrip("/")
    df = io.require_columns(_read(spark, a, f"{out}/rejected"), ["label"])
    # P1 on the input columns. Features derived from the URL are never null;
    # filtering on them would make Catalyst inline every feature expression
    # into the pushed-down predicate.
    df = df.na.drop("any")
    if not set(NUMERIC_FEATURES) <= set(df.columns):
        df = with_url_features(io.require_columns(df, ["url"]), "url")
    bad = df.where(~F.col("label").cast("int").isin(0, 1)).limit(1).count()                # P2
    if bad:
        raise ValueError("label must be 0/1")
    if a.key not in df.columns:
        df = df.withColumn(a.key, F.xxhash64(*[F.col(c) for c in df.columns]))
    # The split is re-read by every trainer: write it once to the output folder.
    io.write_table(K.stratified_split(df.withColumn("label", F.col("label").cast("int")), a.key), f"{out}/split")
    split = spark.read.parquet(f"{out}/split")
    train, test = split.where("split = 'train'"), split.where("split = 'test'")
    numeric = numeric_feature_columns(train, exclude=("label", "tld", a.key))                # P5
    # each model is saved when it is done; a run that was broken off goes on from there
    fitted, scored, rows, failures = Z.train_all(train, test, names=a.models, preset=a.preset, numeric=numeric, save_dir=f"{out}/models")
    for name, err in failures.items():
        print(f"model {name} failed: {err}")
    io.write_metrics(M.rank_models(rows), f"{out}/metrics")
    # everything below reads the written metrics and the written scored rows
    metrics = spark.read.schema(M.rank_models(rows).schema).json(f"{out}/metrics/model_comparison_json")
    best = metrics.where("is_best").first()["model"]
    io.save_model(fitted[best], f"{out}/models/best")
    io.write_roc(M.roc_points(M.curve(scored)), metrics, f"{out}/metrics")
    io.write_confusion(M.confusion_long(scored), f"{out}/metrics")
    io.write_best_meta(metrics.drop("rank", "is_best"), fitted[best].feature_names, train.count(), test.count(), f"{out}/metrics")
    try:  # E8: attribution failure must not fail training
        fm = fitted[best]
        sample = K.hash_sample(test, a.key, 2000)
        x = fm.design(sample, [a.key, "label", "sample_rank"])
        io.write_table(permutation_importance(fm.model, x, a.key, fm.feature_names), f"{out}/attribution")   # E5
        rows, background = (fm.design(K.hash_sample(test, a.key, n), [a.key]) for n in (a.explain_rows, BACKGROUND_ROWS))
        io.write_table(coalition_attribution(rows, background, model_score(fm.model), a.key, fm.feature_names), f"{out}/attribution_rows")
    except Exception as exc:
        print(f"attribution skipped: {type(exc).__name__}: {exc}")


def cmd_score(spark, a):
    from .functions.url import with_url_features
    from .operators import score as S
    from .session import written
    from .sources import io
    out = a.output.rstrip("/")
    urls = io.require_columns(_read(spark, a, f"{out}_rejected"), ["url"])
    fm = io.load_model(spark, a.model_dir)
    # the input columns travel as one struct, so none can clash with a feature
    feats = with_url_features(urls.select(F.struct("*").alias("__in"), "url"), "url")
    scored = written(S.with_verdict(fm.score(feats, ["__in"])))
    added = [c for c in ("verdict", "probability", "risk_score") if c not in urls.columns]
    io.write_predictions(scored.select("__in.*", *added), a.output, a.format)
    io.write_table(S.batch_kpis(scored), f"{out}_summary/kpis")                   # G13
    io.write_table(S.score_histogram(scored), f"{out}_summary/histogram")         # G12


def cmd_eda(spark, a):
    from .functions.url import NUMERIC_FEATURES
    from .operators import eda
    from .session import written
    from .sources import io
    out = a.output_dir.rstrip("/")
    df = written(_read(spark, a, f"{out}/rejected"))
    feats = [c for c in NUMERIC_FEATURES if c in df.columns]
    io.write_table(eda.dataset_kpis(df, feats), f"{out}/kpis")
    io.write_table(eda.class_balance(df), f"{out}/class_balance")
    if "tld" in df.columns:
        top = df.groupBy("tld").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), F.asc("tld")).limit(20)
        io.write_table(top, f"{out}/top_tlds")
    io.write_table(eda.correlation_matrix(df, feats + ["label"]), f"{out}/corr_matrix")
    io.write_table(eda.label_correlation(df, feats), f"{out}/label_correlation")
    io.write_table(eda.class_means(df, feats), f"{out}/class_means")
    io.write_table(eda.describe(df, feats), f"{out}/describe")
    io.write_table(eda.histogram(df, feats, bins=60, density=True), f"{out}/histogram")
    io.write_table(eda.box_stats(df, feats), f"{out}/box")
    io.write_table(eda.null_profile(df), f"{out}/null_profile")


def cmd_report(spark, a):
    """Comparison, bars and model card from the artifacts of a training run; nothing is scored again."""
    from .operators import metrics as M
    from .sources import io
    src, out = a.input.rstrip("/"), a.output_dir.rstrip("/")
    metrics = io.read_artifact(spark, f"{src}/model_comparison_json", "json")
    if metrics is None:
        raise ValueError(f"no model comparison in {src}")
    metrics = metrics.drop("rank", "is_best")
    io.write_table(M.metric_report(metrics), f"{out}/comparison")
    io.write_table(M.metric_bars(metrics), f"{out}/bars")
    card = metrics.select("model", "roc_auc", "accuracy", "tp", "fp", "tn", "fn")
    for name, column in (("roc_curves", "n_roc_points"), ("confusion", "n_confusion_cells")):
        table = io.read_artifact(spark, f"{src}/{name}")
        if table is not None:
            card = card.join(table.groupBy("model").agg(F.count(F.lit(1)).alias(column)), "model", "left")
    io.write_table(card, f"{out}/card")


def main(argv=None):
    p = argparse.ArgumentParser(prog="urlsight")
    p.add_argument("--master", default=None)
    sub = p.add_subparsers(dest="cmd", required=True)
    jobs = {name: sub.add_parser(name) for name in ("features", "train", "score", "eda", "report")}
    for name, job in jobs.items():
        job.add_argument("--input", required=True)
        job.add_argument("--input-format", default=None, choices=["csv", "json", "parquet"])
        job.add_argument("--output" if name in ("features", "score") else "--output-dir", required=True)
    jobs["features"].add_argument("--url-col", default="url")
    jobs["features"].add_argument("--format", default="parquet")
    jobs["train"].add_argument("--preset", default="reference", choices=["reference", "smoke"])
    jobs["train"].add_argument("--models", nargs="*", default=None)
    jobs["train"].add_argument("--key", default="row_id")
    jobs["train"].add_argument("--explain-rows", type=int, default=100)
    jobs["score"].add_argument("--model-dir", required=True)
    jobs["score"].add_argument("--format", default="csv")
    a = p.parse_args(argv)

    from .session import discard_written, ensure_checkpoint_dir, tables_written
    builder = SparkSession.builder.appName(f"urlsight-{a.cmd}")
    spark = (builder.master(a.master) if a.master else builder).getOrCreate()
    ensure_checkpoint_dir(spark)
    before = tables_written()
    try:
        {"features": cmd_features, "train": cmd_train, "score": cmd_score, "eda": cmd_eda, "report": cmd_report}[a.cmd](spark, a)
    finally:
        discard_written(spark, before)      # all results are in the output folder


if __name__ == "__main__":
    main()
