"""Streaming scoring gives the same rows as batch scoring."""

from pyspark.sql import functions as F

from conftest import SF0001
from skylane.operators import bayes, sampling
from skylane.plans import features as feats
from skylane.plans import training
from skylane.plans.scoring import score_batch, shared_path
from skylane.streaming.scoring import read_cleaned_stream, score_stream


def test_stream_matches_batch(spark):
    lab = training.cleaned_labelled(spark, SF0001)
    s = sampling.stratified_split(lab, feats.LABEL_COL)
    train = s.where("IS_TEST = 0").drop("IS_TEST")
    test = s.where("IS_TEST = 1").drop("IS_TEST")
    fitted = feats.fit_features(train, one_hot=False)
    model = bayes.fit_gaussian_nb(feats.whitelist(fitted.transform(train)), feats.KEEP_FEATURES, feats.LABEL_COL)
    src = shared_path(spark, "stream-src")
    test.write.mode("overwrite").parquet(src)
    stream = read_cleaned_stream(spark, src, test.schema)
    q = score_stream(stream, model, fitted).writeStream.format("memory").queryName("scored_stream").start()
    q.processAllAvailable()
    q.stop()
    got = spark.table("scored_stream")
    want = score_batch(test, model, fitted).select("ROW_ID", "PROBA", "PREDICTION")
    assert got.count() == want.count() > 0
    diff = got.join(want.withColumnRenamed("PROBA", "P2").withColumnRenamed("PREDICTION", "Y2"), "ROW_ID")
    assert diff.where((F.abs(F.col("PROBA") - F.col("P2")) > 1e-12) | (F.col("PREDICTION") != F.col("Y2"))).count() == 0
