"""Physical-plan checks: pushdown, broadcast lookups, no Python UDFs in the hot path."""

from pyspark.sql import functions as F

from conftest import SF0001
from skylane.operators import bayes, clean
from skylane.plans import features as feats
from skylane.plans import training
from skylane.sources.tables import airports_view, flights_view, read_table


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_filter_pushed_to_parquet(spark):
    ev = read_table(spark, SF0001, "events", raw=True).select("event_id", "value")
    p = plan(clean.sigma_filter(ev, "value", 3.0))
    assert "PushedFilters: [IsNotNull(value), GreaterThanOrEqual(value" in p
    assert "ReadSchema: struct<event_id:bigint,value:double>" in p


def test_airport_lookup_is_broadcast(spark):
    j = clean.airport_coordinates(flights_view(spark, SF0001), airports_view(spark, SF0001))
    p = plan(j)
    assert "BroadcastHashJoin" in p or "BroadcastExchange" in p


def test_scoring_has_no_python(spark):
    sfe = training.split_features(spark, SF0001)
    m = bayes.fit_gaussian_nb(sfe.train, feats.KEEP_FEATURES, feats.LABEL_COL)
    p = plan(m.transform(sfe.test))
    assert "BatchEvalPython" not in p and "ArrowEvalPython" not in p


def test_split_and_folds_shuffle_no_rows(spark):
    """Cuts are literals: the split and the folds add no exchange, window or aggregate to the rows' plan."""
    from skylane.operators import sampling

    rows = read_table(spark, SF0001, "lineitem").select(F.md5(F.concat("l_orderkey", "l_partkey", "l_linenumber")).alias("ROW_ID"), (F.col("l_quantity") > 25).cast("int").alias("y"), "l_comment" if "l_comment" in read_table(spark, SF0001, "lineitem").columns else "l_tax")
    for df in (sampling.stratified_split(rows, "y"), sampling.kfold(rows)):
        p = plan(df)
        assert "Exchange" not in p and "Window" not in p and "Aggregate" not in p


def test_target_filter_sits_below_the_lookups(spark):
    df = clean.clean_flights(flights_view(spark, SF0001), airports_view(spark, SF0001))
    p = df._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" not in p
    lines = p.split("\n")
    depth = lambda x: len(x) - len(x.lstrip(" :+-"))
    lookup = min(depth(x) for x in lines if "Join LeftOuter" in x)
    # the filter on the computed target stands deeper than the outermost lookup
    assert any("Filter" in x and "l_discount" in x and depth(x) > lookup for x in lines)


def test_rank_windows_expand_no_long_arrays(spark):
    from skylane.operators.ranks import bucketed_row_number

    df = spark.range(10).select((F.col("id") % 2).cast("int").alias("b")).union(spark.range(5).select(F.lit(0).alias("b")))
    got = sorted(r["r"] for r in bucketed_row_number(df, "b", [], out="r").collect())
    assert got == list(range(15))


def test_flight_lines_are_shuffled_once(spark):
    """Orders meet their customers before the lines do, so one exchange at most stands above the lines."""
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "1000")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        lines = plan(flights_view(spark, SF0001).select("ROW_ID", "AIRLINE", "ORIGIN_AIRPORT")).split("\n")
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    depth = lambda x: len(x) - len(x.lstrip(" :+-|"))
    at = next(i for i, x in enumerate(lines) if "Scan parquet" in x and "l_orderkey" in x)
    above, d = [], depth(lines[at])
    for x in reversed(lines[:at]):
        if depth(x) < d:
            above, d = [*above, x], depth(x)
    by_order = [x for x in above if "Exchange" in x and "l_suppkey" not in x.split("hashpartitioning(")[-1].split(",")[0]]
    assert len(by_order) == 1


def test_suppliers_do_not_shuffle_the_lines_again(spark):
    """Suppliers beyond Spark's own broadcast threshold but within the proved bound: no exchange of lines by supplier."""
    old = {c: spark.conf.get(c) for c in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        p = plan(flights_view(spark, SF0001).select("ROW_ID", "AIRLINE", "ORIGIN_AIRPORT"))
    finally:
        for c, v in old.items():
            spark.conf.set(c, v)
    assert "hashpartitioning(l_orderkey" in p and "hashpartitioning(l_suppkey" not in p


def test_single_use_scores_keep_no_rows(spark):
    """Queries that read each side once cache neither, and the frequency is looked up over source columns."""
    from skylane.plans.catalog import REGISTRY

    p = REGISTRY["predicted_share"](spark, SF0001)._jdf.queryExecution().toString()
    assert "InMemoryRelation" not in p
    sfe = training.split_features(spark, SF0001, persist=False)
    lines = sfe.train._jdf.queryExecution().optimizedPlan().toString().split("\n")
    at = next(i for i, x in enumerate(lines) if "Join" in x and "FLIGHT_NUMBER" in x)
    assert not any("SIN(" in x.upper() and "AS DAY_OF_YEAR_SIN" in x for x in lines[at:])


def test_split_reads_staged_rows(spark):
    """The split and its feature tables do not join the lines again for each pass."""
    sfe = training.split_features(spark, SF0001)
    for df in (sfe.train, sfe.test):
        p = df._jdf.queryExecution().toString()
        assert "lineitem.parquet" not in p and "l_orderkey" not in p
    sfe.release()
