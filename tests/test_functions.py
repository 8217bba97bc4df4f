"""Edge rows (FIXTURES.md D) with hand-written expectations."""

import math

import pytest
from pyspark.sql import functions as F

from skylane.functions import features as fx
from skylane.operators import clean, encode, metrics, select


def col_values(df, c):
    return [r[c] for r in df.collect()]


def one_col(spark, values, typ="int"):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], f"i int, x {typ}").orderBy("i")


def test_hhmm_to_minutes(spark):
    df = one_col(spark, [0, 59, 100, 2359, 2400, None, -5])
    got = col_values(df.select(fx.hhmm_to_minutes("x").alias("m")), "m")
    assert got == [0, 59, 60, 1439, 1440, None, 35]


def test_time_period(spark):
    df = one_col(spark, [0, 359, 360, 719, 720, 1079, 1080, 2359, -1, None])
    got = col_values(df.select(fx.time_period("x").alias("p")), "p")
    assert got == ["midnight", "midnight", "morning", "morning", "afternoon", "afternoon",
                   "night", "night", "night", "night"]


def test_rush_hour(spark):
    df = one_col(spark, [359, 360, 539, 540, 1019, 1020, 1199, 1200, None])
    assert col_values(df.select(fx.rush_hour("x").alias("r")), "r") == [0, 1, 1, 0, 0, 1, 1, 0, 0]


def test_season(spark):
    df = one_col(spark, [79, 80, 171, 172, 265, 266, 354, 355, 366, None])
    got = col_values(df.select(fx.season("x").alias("s")), "s")
    assert got == ["winter", "spring", "spring", "summer", "summer", "autumn", "autumn", "winter", "winter", None]


def test_distance_bins(spark):
    df = one_col(spark, [0.0, 0.1, 500.0, 500.1, 1000.0, 2000.0, 1e9, -1.0, None], "double")
    got = col_values(df.select(fx.distance_bins("x").alias("b")), "b")
    assert got == [None, "short", "short", "medium", "medium", "long", "very_long", None, None]


def test_weekend_and_target(spark):
    df = one_col(spark, [1, 5, 6, 7, None])
    assert col_values(df.select(fx.weekend("x").alias("w")), "w") == [0, 0, 1, 1, 0]
    t = one_col(spark, [14.999, 15.0, None], "double")
    assert col_values(t.select(fx.binarise("x").alias("y")), "y") == [0, 1, 0]


def test_cyclic_unit_circle(spark):
    df = spark.range(0, 1440, 7).select(F.col("id").alias("m"))
    s, c = fx.cyclic("m", 1440)
    err = df.select(F.max(F.abs(s * s + c * c - 1)).alias("e")).first()["e"]
    assert err < 1e-12


def test_scalers_constant_single_null(spark):
    df = one_col(spark, [3.0, 3.0, None], "double")
    std = encode.normalize_column(df, "x", "standard")
    assert col_values(std, "x_NORMALIZED") == [0.0, 0.0, None]
    mm = encode.normalize_column(df, "x", "minmax")
    assert col_values(mm, "x_NORMALIZED") == [0.0, 0.0, None]
    single = encode.normalize_column(one_col(spark, [7.0], "double"), "x")
    assert col_values(single, "x_NORMALIZED") == [0.0]


def test_sigma_filter_bounds_inclusive(spark):
    # mean 2, sample std 1 -> bounds [1, 3] at k = 1: both ends kept
    df = one_col(spark, [1.0, 2.0, 3.0], "double")
    assert sorted(col_values(clean.sigma_filter(df, "x", 1.0), "x")) == [1.0, 2.0, 3.0]
    assert clean.sigma_filter(one_col(spark, [5.0], "double"), "x", 1.0).count() == 0


def test_zscore_filter(spark):
    # population std of [-1, 1] is 1: |z| = 1 exactly is dropped at threshold 1
    df = one_col(spark, [-1.0, 1.0], "double")
    assert clean.zscore_filter(df, "x", 1.0).count() == 0
    assert clean.zscore_filter(df, "x", 1.01).count() == 2
    with_null = one_col(spark, [-1.0, 1.0, None], "double")
    assert clean.zscore_filter(with_null, "x", 3.0, nulls="propagate").count() == 0
    assert clean.zscore_filter(with_null, "x", 3.0, nulls="skip").count() == 2


def test_frequency_null_key(spark):
    df = one_col(spark, [1, 1, 2, None])
    out = encode.frequency_encode(df, "x").orderBy("i")
    got = col_values(out, "x_FREQ")
    assert got[:3] == pytest.approx([2 / 3, 2 / 3, 1 / 3]) and got[3] is None


def test_large_frequency_table_is_not_copied(spark):
    """A table beyond the broadcast bound: hot, rare, unseen and NULL keys, and no row of it more than once."""
    rows = [(i, 7) for i in range(1500)] + [(2000 + i, 100 + i // 2) for i in range(2400)] + [(9000, None), (9001, None)]
    train = spark.createDataFrame(rows, "i int, Key int")
    table = encode.fit_frequency(train, "Key")
    odd = spark.createDataFrame([(9002, 55), (9003, 55)], "i int, Key int")
    df = train.unionByName(odd).withColumn("other", F.lit("x"))
    small, large = (encode.apply_frequency(df, table, "Key", **bound) for bound in ({}, {"max_broadcast_bytes": 1000}))
    assert large.columns == small.columns == ["Key", "i", "other", "Key_FREQ"] and large.dtypes == small.dtypes
    got = large.collect()
    assert sorted(map(str, got)) == sorted(map(str, small.collect())) and len(got) == len(rows) + 2
    p = large._jdf.queryExecution().optimizedPlan().toString()
    assert "explode" not in p.lower()
    # the salt is a key of the join, so the hot and NULL keys' rows do not meet in one task
    joined = next(x for x in p.split("\n") if "Join" in x)
    assert joined.count("_salt#") == 2 and joined.count("_cold#") == 2
    unseen = {r["Key_FREQ"] for r in got if r["i"] >= 9000}
    assert unseen == {None}


def test_one_hot_null_and_unseen(spark):
    train = spark.createDataFrame([(1, "b"), (2, "a"), (3, None)], "i int, c string")
    cats = encode.fit_categories(train, ["c"])
    assert cats == {"c": ["a", "b", None]}
    test = spark.createDataFrame([(4, "z"), (5, None)], "i int, c string")
    out = encode.apply_one_hot(test, cats).orderBy("i").collect()
    assert [tuple(r[c] for c in ("c_a", "c_b", "c_nan")) for r in out] == [(0.0, 0.0, 0.0), (0.0, 0.0, 1.0)]


def test_exact_quantile_interpolates(spark):
    df = one_col(spark, [1.0, 2.0, 3.0, 10.0], "double")
    assert clean.exact_quantiles(df, "x", [0.25, 0.0, 1.0, 0.5]) == pytest.approx([1.75, 1.0, 10.0, 2.5])


def test_exact_quantile_hot_value(spark):
    # a third of the rows share one value; compare with numpy's linear interpolation
    import numpy as np

    vals = [5.0] * 400 + [float(i) for i in range(800)]
    df = spark.createDataFrame([(v,) for v in vals], "x double")
    ps = [0.1, 0.33, 0.5, 0.77, 0.999]
    assert clean.exact_quantiles(df, "x", ps, buckets=16) == pytest.approx(list(np.quantile(vals, ps)))


def test_exact_quantile_refines_large_buckets(spark):
    # max_rows forces the per-bucket refinement; a hot value (a third of the rows) must stop it cleanly
    import numpy as np

    rng = np.random.default_rng(7)
    vals = [3.5] * 1500 + rng.normal(0, 10, 3000).round(3).tolist()
    df = spark.createDataFrame([(float(v),) for v in vals], "x double")
    ps = [0.01, 0.2, 0.34, 0.5, 0.66, 0.9, 0.995]
    got = clean.exact_quantiles(df, "x", ps, buckets=4, max_rows=20)
    assert got == pytest.approx(list(np.quantile(vals, ps)))


def test_auc_ties_and_constant(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.1)], "y int, p double")
    assert metrics.roc_auc(df, "y", "p").first()["roc_auc"] == pytest.approx(2 / 3)
    const = spark.createDataFrame([(1, 0.5), (0, 0.5), (1, 0.5)], "y int, p double")
    assert metrics.roc_auc(const, "y", "p").first()["roc_auc"] == pytest.approx(0.5)


def test_roc_curve_points(spark):
    df = spark.createDataFrame([(1, 0.9), (0, 0.8), (1, 0.8), (0, 0.1), (1, 0.1)], "y int, p double")
    pts = [(r["threshold"], r["fpr"], r["tpr"]) for r in metrics.roc_curve(df, "y", "p").orderBy(F.desc("threshold")).collect()]
    assert pts[0] == (math.inf, 0.0, 0.0)
    # steps 0.9 -> 0.8 -> 0.1 are equal (+1 pos, +1 neg), so 0.8 is collinear and dropped
    assert pts[1:] == [(0.9, 0.0, pytest.approx(1 / 3)), (0.1, 1.0, 1.0)]
    full = metrics.roc_curve(df, "y", "p", drop_intermediate=False).count()
    assert full == 4


def test_zero_division_metrics(spark):
    df = spark.createDataFrame([(1, 0), (0, 0)], "y int, p int")
    r = metrics.classification_metrics(df, "y", "p").first()
    assert (r["precision"], r["recall"], r["f1"]) == (0.0, 0.0, 0.0)


def test_correlation_constant_column(spark):
    df = spark.createDataFrame([(1.0, 1.0, 1), (1.0, 2.0, 0), (1.0, 3.0, 1)], "c double, v double, y int")
    s = select.correlation_screen(df, ["c", "v"], "y").orderBy("rank").collect()
    assert s[0]["feature"] == "v" and s[1]["feature"] == "c" and s[1]["abs_corr"] is None


def test_narrowing_bounds_are_strict(spark):
    df = spark.createDataFrame([(126, 127, 2.5)], "a bigint, b bigint, c double")
    assert encode.narrow_types_plan(df) == {"a": "tinyint", "b": "smallint", "c": "float"}


def test_uppercase_collision(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    assert encode.uppercase_columns(df).columns == ["A", "B"]


def test_strict_drop(spark):
    df = spark.createDataFrame([(1, 2)], "a int, b int")
    with pytest.raises(KeyError):
        clean.drop_columns(df, ["zz"])
