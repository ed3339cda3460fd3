"""Split/sampling (K1-K4) and encoding (N1-N7) invariants."""
from pyspark.sql import functions as F

from urlsight.functions.url import NUMERIC_FEATURES
from urlsight.operators import encode as N
from urlsight.operators import split as K
from urlsight.sources import tables as T

from .conftest import SF_MID


def test_split_disjoint_complete_and_sized(spark):
    lu = T.labelled_urls(spark, SF_MID)
    sp = K.stratified_split(lu, "page_id")
    assert sp.count() == lu.count()
    assert sp.where("split = 'test'").select("page_id").intersect(sp.where("split = 'train'").select("page_id")).count() == 0
    for r in sp.groupBy("label").agg(F.count("*").alias("n"), F.count_if(F.col("split") == "test").alias("t")).collect():
        assert r["t"] == int(r["n"] * 0.2 + 0.5)


def test_split_deterministic(spark):
    a = K.stratified_split(T.labelled_urls(spark, SF_MID), "page_id").where("split='test'").select("page_id")
    b = K.stratified_split(T.labelled_urls(spark, SF_MID), "page_id").where("split='test'").select("page_id")
    assert a.exceptAll(b).count() == 0


def test_one_hot_rows_sum_to_one(spark):
    uf = T.url_features(spark, SF_MID)
    vocab = [r["tld"] for r in N.tld_vocabulary(uf, top_n=2).collect()]
    enc = N.encode(uf, vocab)
    dummy = N.dummy_names(vocab)
    total = sum(F.col(c) for c in dummy)
    assert enc.where(total != 1).count() == 0
    assert enc.columns == N.feature_names(vocab)


def test_missing_tld_gives_zero_dummies_and_parity(spark):
    df = spark.createDataFrame([(1, 10)], "id int, url_len int")
    enc = N.encode(df, ["com", "net"], keep=["id"])
    r = enc.first()
    assert r["tld_com"] == 0 and r["tld_other"] == 0 and r["url_len"] == 10 and r["entropy"] == 0
    assert enc.columns == ["id"] + NUMERIC_FEATURES + ["tld_com", "tld_net", "tld_other"]


def test_vocab_estimator_roundtrip(spark, tmp_out):
    uf = T.url_features(spark, SF_MID)
    model = N.TldVocab(topN=2).fit(uf)
    model.write().overwrite().save(f"{tmp_out}/vocab")
    again = N.TldVocabModel.load(f"{tmp_out}/vocab")
    assert again.getVocabulary() == model.getVocabulary() and len(model.getVocabulary()) == 2
    out = again.transform(uf.select("page_id", "tld"))
    assert {"tld_other"} <= set(out.columns)


def test_hash_sample_is_topk(spark):
    s = K.hash_sample(T.url_features(spark, SF_MID), "page_id", 10).collect()
    assert [r["sample_rank"] for r in s] == list(range(1, 11)) or sorted(r["sample_rank"] for r in s) == list(range(1, 11))


def test_numeric_discovery_and_text_drop(spark):
    uf = T.url_features(spark, SF_MID).withColumn("label", F.lit(0))
    cols = N.numeric_feature_columns(uf, exclude=("label", "tld", "page_id"))
    assert cols == NUMERIC_FEATURES
    assert "url" not in N.drop_text_columns(uf).columns and "dom" not in N.drop_text_columns(uf).columns
