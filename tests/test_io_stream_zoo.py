"""Sources/sinks (S2-S14), streaming (Z1, Z2) and the trainer zoo."""
import os
import time

import pytest
from pyspark.sql import functions as F

from urlsight.operators import split as K
from urlsight.operators import zoo as Z
from urlsight.sources import io
from urlsight.sources import tables as T
from urlsight.streaming import stream as ST

from .conftest import SF_MID, SF_SMALL


def test_require_columns_names_found_columns(spark):
    df = spark.createDataFrame([(1, "x")], "id int, link string")
    with pytest.raises(io.MissingColumnError, match="found columns: \\['id', 'link'\\]"):
        io.require_columns(df, ["url"])


def test_corrupt_csv_rows_kept(spark, tmp_out):
    path = os.path.join(tmp_out, "in.csv")
    with open(path, "w") as f:
        f.write('url,n\nhttp://a.com,1\n"http://b.com,unterminated\nhttp://c.com,x\n')
    df = io.read_csv(spark, path, "url string, n int")
    assert df.count() >= 2 and io.CORRUPT_COL in df.columns


def test_template_and_predictions_roundtrip(spark, tmp_out):
    io.write_sample_template(spark, f"{tmp_out}/tpl")
    urls = io.read_urls(spark, f"{tmp_out}/tpl")
    assert urls.count() == 5


def test_artifact_absence_tolerated(spark, tmp_out):
    assert io.read_artifact(spark, f"{tmp_out}/nope") is None


def _split(spark, d):
    sp = K.stratified_split(T.weak_labelled_urls(spark, d), "page_id")
    return sp.where("split = 'train'"), sp.where("split = 'test'")


@pytest.mark.parametrize("name", ["LogisticRegression", "AdaBoost", "RandomForest", "ExtraTrees", "XGBoost", "LightGBM", "CatBoost", "HistGradientBoosting"])
def test_model_save_load_same_scores(spark, tmp_out, name):
    train, test = _split(spark, SF_MID)
    vm, names = Z.prepare(train)
    fm = Z.fit_one(Z.TRAINERS[name], train, vm, names, "smoke")
    io.save_model(fm, f"{tmp_out}/{name}")
    back = io.load_model(spark, f"{tmp_out}/{name}")
    a = fm.score(test, ["page_id"]).withColumnRenamed("p", "a")
    b = back.score(test, ["page_id"]).withColumnRenamed("p", "b")
    j = a.join(b, "page_id")
    assert j.count() == test.count() and j.where(F.abs(F.col("a") - F.col("b")) > 1e-12).count() == 0


def test_train_all_isolates_failures(spark, monkeypatch):
    train, test = _split(spark, SF_SMALL)

    def boom(preset, w):
        raise RuntimeError("broken trainer")
    monkeypatch.setitem(Z.TRAINERS, "Broken", Z.Trainer("Broken", boom, None))
    fitted, scored, rows, failures = Z.train_all(train, test, names=["Broken", "LogisticRegression"], preset="smoke")
    assert "Broken" in failures and list(fitted) == ["LogisticRegression"] and rows.count() == 1 and scored.count() == test.count()
    with pytest.raises(Z.EveryModelFailed, match="broken trainer"):
        Z.train_all(train, test, names=["Broken"], preset="smoke")


@pytest.mark.parametrize("query", ["model_report", "model_comparison"])
def test_a_failed_model_is_no_row_less(spark, monkeypatch, query):
    """The queries list all models: with one that can't be fitted they have no result."""
    from urlsight.plans import model_queries as Q

    def boom(preset, w):
        raise RuntimeError("broken trainer")
    monkeypatch.setattr(Z, "TRAINERS", {"Broken": Z.Trainer("Broken", boom, None), "Small": Z.Trainer("Small", lambda p, w: Z._rf("smoke", w, Z.BAGGING), None)})
    with pytest.raises(RuntimeError, match="Broken: RuntimeError: broken trainer"):
        getattr(Q, query)(spark, SF_SMALL)


def test_a_model_without_probabilities(spark):
    """V4: the class is the model's prediction; no percent, no log loss, ranked by its margin."""
    from pyspark.ml.classification import LinearSVC
    from urlsight.operators import score as S
    train, test = _split(spark, SF_MID)
    vm, names = Z.prepare(train)
    data = Z.training_table(train, vm, names)
    fm = Z.FittedModel("SVC", vm, names, LinearSVC(maxIter=20).fit(data), 0.0)
    rows = S.with_verdict(fm.score(test, ["page_id"])).collect()
    assert all(r.p is None and r.probability is None and r.risk_score is None and r.risk_band is None and r.gauge_position is None for r in rows)
    assert all(r.verdict == ("phishing" if r.prediction == 1 else "safe") for r in rows) and {r.verdict for r in rows} == {"phishing", "safe"}
    m = Z.evaluate(fm, test).first()
    assert m.log_loss is None and m.roc_auc > 0.9 and m.tp + m.fp + m.tn + m.fn == test.count()


def test_extra_numeric_columns_are_learned_from(spark):
    from urlsight.operators.encode import numeric_feature_columns
    from urlsight.functions.url import NUMERIC_FEATURES
    train, test = [x.withColumn("extra", F.col("label") * 3.0) for x in _split(spark, SF_SMALL)]
    numeric = numeric_feature_columns(train, exclude=("label", "page_id"))
    assert numeric == [*NUMERIC_FEATURES, "extra"]
    vm, names = Z.prepare(train, numeric=numeric)
    fm = Z.fit_one(Z.TRAINERS["LogisticRegression"], train, vm, names, "smoke")
    assert "extra" in fm.feature_names and fm.score(test, ["page_id"]).count() == test.count()


def test_an_exact_tie_is_class_zero_in_evaluation(spark):
    class Half:
        def transform(self, df):
            return Z.AdaBoostModel([((0, 0.0, 0.0, 1.0), 1.0), ((0, 0.0, 1.0, 0.0), 1.0)]).transform(df)
    train, test = _split(spark, SF_SMALL)
    vm, names = Z.prepare(train)
    m = Z.evaluate(Z.FittedModel("Half", vm, names, Half(), 0.0), test).first()
    assert m.tp == m.fp == 0 and m.tn + m.fn == test.count()
    scored = Z.FittedModel("Half", vm, names, Half(), 0.0).score(test, ["page_id"])
    from urlsight.operators.score import with_verdict
    assert {r.verdict for r in with_verdict(scored).collect()} == {"phishing"}   # P11 keeps >= 0.5


def test_train_all_goes_on_from_saved_models(spark, tmp_out, monkeypatch):
    train, test = _split(spark, SF_SMALL)
    first = Z.train_all(train, test, names=["AdaBoost", "LightGBM"], preset="smoke", save_dir=f"{tmp_out}/m")
    monkeypatch.setattr(Z, "fit_one", lambda *a: (_ for _ in ()).throw(AssertionError("fitted again")))
    again = Z.train_all(train, test, names=["AdaBoost", "LightGBM"], preset="smoke", save_dir=f"{tmp_out}/m")
    assert not again[3] and sorted(again[1].collect()) == sorted(first[1].collect())
    with pytest.raises(Z.EveryModelFailed, match="fitted again"):     # other rows: the saved models are not theirs
        Z.train_all(train.limit(30), test, names=["AdaBoost"], preset="smoke", save_dir=f"{tmp_out}/m")


def test_class_weights_balanced(spark):
    w = Z.with_class_weights(T.labelled_urls(spark, SF_MID))
    r = w.groupBy("label").agg(F.sum("w_balanced").alias("s"), F.count("*").alias("n")).collect()
    total = sum(x["n"] for x in r)
    for x in r:
        assert x["s"] == pytest.approx(total / 2)


def test_stream_windows_equal_batch_for_closed_windows(spark):
    batch = ST.windowed_verdicts(T.table(spark, SF_SMALL, "events"))
    stream = ST.windowed_verdicts_stream(spark, SF_SMALL, "10 minutes", mode="append")
    # append mode emits a window once the watermark (max ts - 10 min) passes its end
    cutoff = T.table(spark, SF_SMALL, "events").agg(F.max("ts")).first()[0]
    import datetime
    closed = batch.where(F.col("window_end") <= F.lit(cutoff - datetime.timedelta(minutes=10)))
    assert stream.exceptAll(closed).count() == 0 and closed.exceptAll(stream).count() == 0


def test_stream_score_equals_batch_score(spark):
    from urlsight.plans import model_queries, stream_queries
    s = stream_queries.stream_score_rows(spark, SF_SMALL)
    b = model_queries.batch_score_rows(spark, SF_SMALL)
    cols = ["page_id", "verdict", "probability", "risk_score"]
    assert s.select(cols).exceptAll(b.select(cols)).count() == 0 and s.count() == b.count()


def test_cli_train_and_score(spark, tmp_out):
    from urlsight.cli import main
    T.weak_labelled_urls(spark, SF_SMALL).select("page_id", "url", "label").write.parquet(f"{tmp_out}/lab")
    main(["train", "--input", f"{tmp_out}/lab", "--output-dir", f"{tmp_out}/run", "--preset", "smoke",
          "--models", "LogisticRegression", "RandomForest", "--key", "page_id"])
    for sub in ["metrics/model_comparison_csv", "metrics/roc_curves", "metrics/confusion", "metrics/best_meta",
                "models/best", "attribution", "attribution_rows"]:
        assert io.path_exists(spark, f"{tmp_out}/run/{sub}"), sub
    main(["score", "--input", f"{tmp_out}/lab", "--model-dir", f"{tmp_out}/run/models/best",
          "--output", f"{tmp_out}/preds"])
    preds = spark.read.option("header", True).csv(f"{tmp_out}/preds")
    assert preds.count() == 50 and {"verdict", "probability", "risk_score", "label"} <= set(preds.columns)
    assert spark.read.parquet(f"{tmp_out}/preds_summary/kpis").first().n == 50
    assert spark.read.parquet(f"{tmp_out}/preds_summary/histogram").agg(F.sum("n")).first()[0] == 50
    main(["report", "--input", f"{tmp_out}/run/metrics", "--output-dir", f"{tmp_out}/report"])
    card = spark.read.parquet(f"{tmp_out}/report/card").collect()
    assert {r.model for r in card} == {"LogisticRegression", "RandomForest"} and all(r.n_confusion_cells == 4 for r in card)
    assert spark.read.parquet(f"{tmp_out}/report/comparison").where("is_best").count() == 1
    assert spark.read.parquet(f"{tmp_out}/report/bars").count() == 8


def test_cli_train_survives_a_failing_attribution(spark, tmp_out, monkeypatch, capsys):
    """The models and metrics are there, the failure is told."""
    from urlsight.cli import main
    from urlsight.operators import attribution
    from urlsight.session import tables_written
    monkeypatch.setattr(attribution, "permutation_importance", lambda *a: 1 / 0)
    before = tables_written()
    T.weak_labelled_urls(spark, SF_SMALL).select("page_id", "url", "label").write.parquet(f"{tmp_out}/lab")
    main(["train", "--input", f"{tmp_out}/lab", "--output-dir", f"{tmp_out}/run", "--preset", "smoke", "--models", "LogisticRegression", "--key", "page_id"])
    assert "attribution skipped: ZeroDivisionError" in capsys.readouterr().out
    assert io.load_model(spark, f"{tmp_out}/run/models/best").name == "LogisticRegression"
    from urlsight import session
    assert session.tables_written() == before         # a job leaves no scratch table
    kept = session.written(spark.range(3))
    path = kept.inputFiles()[0]
    assert kept.count() == 3 and session.discard_written(spark, before) == 1
    assert not io.path_exists(spark, path)
    assert not io.path_exists(spark, f"{tmp_out}/run/attribution")


def test_cli_from_csv_files(spark, tmp_out):
    """Precomputed features, URLs only, and a malformed line."""
    from urlsight.cli import main
    lab = T.weak_labelled_urls(spark, SF_SMALL).drop("page_id")
    lab.coalesce(1).write.option("header", True).csv(f"{tmp_out}/full/csv")
    os.makedirs(f"{tmp_out}/urls/csv")
    with open(f"{tmp_out}/urls/csv/part.csv", "w") as f:
        f.write("url,label\n" + "".join(f"{r.url},{r.label}\n" for r in lab.select("url", "label").collect()))
        f.write("http://b.com/,1,surplus,more\nhttp://c.com/\n")
    for kind, rejected in (("full", 0), ("urls", 2)):
        main(["train", "--input", f"{tmp_out}/{kind}/csv", "--output-dir", f"{tmp_out}/{kind}/run", "--preset", "smoke", "--models", "LogisticRegression"])
        assert spark.read.parquet(f"{tmp_out}/{kind}/run/split").count() == 50
        assert spark.read.parquet(f"{tmp_out}/{kind}/run/rejected").count() == rejected
    main(["score", "--input", f"{tmp_out}/urls/csv", "--model-dir", f"{tmp_out}/full/run/models/best", "--output", f"{tmp_out}/p", "--format", "parquet"])
    assert spark.read.parquet(f"{tmp_out}/p").count() == 50
    main(["eda", "--input", f"{tmp_out}/full/csv", "--output-dir", f"{tmp_out}/eda"])
    assert spark.read.parquet(f"{tmp_out}/eda/kpis").first().n_rows == 50
    assert spark.read.parquet(f"{tmp_out}/eda/label_correlation").count() > 0 and spark.read.parquet(f"{tmp_out}/eda/top_tlds").count() > 0


def test_train_logistic_docs_runs(spark):
    import __spark_entry__ as E
    r = E.queries()["train_logistic_docs"](spark, SF_SMALL).first()
    assert r["held_out_positives"] > 0 and r["held_out_negatives"] > 0


def test_stream_windows_update_mode_equal_batch(spark):
    batch = ST.windowed_verdicts(T.table(spark, SF_SMALL, "events"))
    stream = ST.windowed_verdicts_stream(spark, SF_SMALL, "10 minutes")
    cols = ["window_start", "window_end", "verdict", "n"]
    assert stream.select(cols).exceptAll(batch.select(cols)).count() == 0
    assert batch.select(cols).exceptAll(stream.select(cols)).count() == 0


def _same(a, b):
    cols = ["window_start", "window_end", "verdict", "n"]
    return a.select(cols).exceptAll(b.select(cols)).count() == 0 and b.select(cols).exceptAll(a.select(cols)).count() == 0


def test_stream_over_a_folder_of_files_out_of_order(spark, tmp_out):
    events = T.table(spark, SF_SMALL, "events")
    batch = ST.windowed_verdicts(events).cache()
    day = F.dayofmonth("ts")
    for i in range(5):  # newest first, so that every later file is late
        events.where((day > 24 - 6 * i) & ((day <= 30 - 6 * i) | (i == 0))).coalesce(1).write.mode("append").parquet(f"{tmp_out}/events.parquet")
        time.sleep(0.05)  # files are taken in order of their time
    assert spark.read.parquet(f"{tmp_out}/events.parquet").count() == events.count()
    assert _same(ST.windowed_verdicts_stream(spark, tmp_out, "31 days"), batch)
    assert _same(ST.windowed_verdicts_stream(spark, tmp_out, "31 days", max_files=1), batch)
    with pytest.raises(ST.LateRowsError, match="10 minutes late"):
        ST.windowed_verdicts_stream(spark, tmp_out, "10 minutes", max_files=1)


def test_late_rows_are_kept_and_counted(spark, tmp_out):
    """Files out of order with a delay of an hour equal the batch twin; a repeated batch replaces itself."""
    events = T.table(spark, SF_SMALL, "events")
    batch = ST.windowed_verdicts(events).cache()
    day = F.dayofmonth("ts")
    for i in range(5):      # newest first
        events.where((day > 24 - 6 * i) & ((day <= 30 - 6 * i) | (i == 0))).coalesce(1).write.mode("append").parquet(f"{tmp_out}/events.parquet")
        time.sleep(0.05)
    got = ST.windowed_verdicts_keeping_late(spark, tmp_out, "1 hour", max_files=1).cache()
    assert _same(got, batch)
    first = events.where(day > 24).count()
    assert got.agg(F.sum("n_late")).first()[0] == events.count() - first
    whole = ST.windowed_verdicts_keeping_late(spark, tmp_out, "1 hour")      # all files in one batch: nothing is late
    assert _same(whole, batch) and whole.agg(F.sum("n_late")).first()[0] == 0
    partial = spark.createDataFrame([("a", 2, True), ("a", 3, False)], "verdict string, n long, late boolean").selectExpr("0 AS window_start", "1 AS window_end", "*")
    assert ST.folded(partial).first()[3:] == (5, 2)


def test_cli_features_and_eda(spark, tmp_out):
    from urlsight.cli import main
    T.table(spark, SF_SMALL, "pages").select("page_id", "url").write.parquet(f"{tmp_out}/pages")
    main(["features", "--input", f"{tmp_out}/pages", "--output", f"{tmp_out}/feats"])
    feats = spark.read.parquet(f"{tmp_out}/feats")
    assert feats.count() == 50 and {"tld", "entropy", "url_error", "odd_scheme"} <= set(feats.columns)
    T.labelled_urls(spark, SF_SMALL).write.parquet(f"{tmp_out}/lab")
    main(["eda", "--input", f"{tmp_out}/lab", "--output-dir", f"{tmp_out}/eda"])
    for sub in ["class_balance", "corr_matrix", "class_means", "describe", "histogram", "box", "null_profile"]:
        assert spark.read.parquet(f"{tmp_out}/eda/{sub}").count() > 0, sub
