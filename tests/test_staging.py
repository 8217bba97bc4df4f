"""Staged rows: one write, only kept lines shuffled; cuts narrowed step by step; generated code that HotSpot compiles."""

import datetime as dt
import glob
import math

import pytest
from pyspark.sql import functions as F

from skylane.functions.features import hash_hex
from skylane.operators import ranks, sampling
from skylane.plans import catalog, training
from skylane.session import METHOD_LIMIT, ensure_checkpoint_dir
from skylane.sources import tables


@pytest.fixture(scope="module")
def odd_dir(spark, tmp_path_factory):
    """Lines of every kind: cancelled, diverted, unknown quantity, without an order, customer or supplier, orders that come twice."""
    to = str(tmp_path_factory.mktemp("odd"))
    lines = []
    for i in range(400):
        qty = [1.0, 2.0, None, float("nan")][i % 40] if i % 40 < 4 else float(3 + i % 48)
        ship = None if i % 37 == 0 else dt.datetime(1995 + i % 4, 1 + i % 12, 1 + i % 28, i % 24, 30)
        lines.append((i // 4, i % 90, i % 12, 1 + i % 7, qty, 100.0 + i * 7.25, (i % 11) / 100, (i % 9) / 100, ship))
    spark.createDataFrame(lines, "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_extendedprice double, l_discount double, l_tax double, l_shipdate timestamp").write.parquet(f"{to}/lineitem.parquet")
    spark.createDataFrame([(i % 95, i % 30) for i in range(100)] + [(None, 1)], "o_orderkey long, o_custkey long").write.parquet(f"{to}/orders.parquet")
    spark.createDataFrame([(i, f"S{i % 3}", i % 25) for i in range(28)], "c_custkey long, c_mktsegment string, c_nationkey long").write.parquet(f"{to}/customer.parquet")
    spark.createDataFrame([(i, i % 25) for i in range(11)], "s_suppkey long, s_nationkey long").write.parquet(f"{to}/supplier.parquet")
    spark.createDataFrame([(i, f"N{i}") for i in range(25)], "n_nationkey long, n_name string").write.parquet(f"{to}/nation.parquet")
    return to


def rows(df):
    return sorted(map(repr, df.collect()))


def test_targets_are_those_of_the_flights(spark, odd_dir):
    got = tables.flight_targets(spark, odd_dir)
    assert rows(got) == rows(tables.flights_view(spark, odd_dir).select(*got.columns))


def test_targets_leave_lines_where_they_are(spark, odd_dir, monkeypatch):
    """Only orders without exactly one partner go to the lines; too many to broadcast give the same rows."""
    threshold = "spark.sql.autoBroadcastJoinThreshold"
    before = spark.conf.get(threshold)
    try:
        spark.conf.set(threshold, "-1")
        got = tables.flight_targets(spark, odd_dir)
        plan = got._jdf.queryExecution().executedPlan().toString()
        assert "Exchange hashpartitioning" not in plan and "BroadcastExchange" in plan
        assert "Exchange hashpartitioning" in tables.flight_targets(spark, odd_dir, 0)._jdf.queryExecution().executedPlan().toString()
        want = rows(tables.flights_view(spark, odd_dir).select(*got.columns))
        assert rows(got) == want and rows(tables.flight_targets(spark, odd_dir, 0)) == want
    finally:
        spark.conf.set(threshold, before)


def test_targets_of_lines_with_one_partner_each(spark, odd_dir, tmp_path):
    for t in ("lineitem", "supplier", "customer"):
        spark.read.parquet(f"{odd_dir}/{t}.parquet").write.parquet(f"{tmp_path}/{t}.parquet")
    spark.createDataFrame([(i, i % 28) for i in range(100)], "o_orderkey long, o_custkey long").write.parquet(f"{tmp_path}/orders.parquet")
    got = tables.flight_targets(spark, str(tmp_path))
    assert rows(got) == rows(tables.flights_view(spark, str(tmp_path)).select(*got.columns))


def test_staged_rows_are_written_once_and_shuffle_kept_lines(spark, odd_dir, monkeypatch):
    frames = []
    keep = tables.staged
    monkeypatch.setattr(training, "staged", lambda df: frames.append(df) or keep(df))
    folders = lambda: len(glob.glob(f"{ensure_checkpoint_dir(spark).removeprefix('file:')}/skylane/staged-*"))
    before = folders()
    got = training.staged_labelled(spark, odd_dir)
    assert folders() == before + 1
    want = training.cleaned_labelled(spark, odd_dir)
    assert got.columns == want.columns and got.count() > 50
    assert rows(got) == rows(want)
    # the target's bounds are met by the lines' own scan, below every join
    plan = frames[0]._jdf.queryExecution().optimizedPlan().toString().split("\n")
    bound = next(i for i, x in enumerate(plan) if "Filter" in x and "l_discount" in x and ">=" in x)
    deepest = max(i for i, x in enumerate(plan[:bound]) if "Join" in x)
    assert deepest < bound and "l_shipdate" in "".join(plan[bound:bound + 2]) and "l_tax" not in plan[bound - 1]


@pytest.mark.parametrize("digits, max_rows", [(1, 5), (2, 1), (3, 10**6)])
def test_cuts_do_not_depend_on_steps(spark, digits, max_rows):
    df = spark.createDataFrame([(f"r{i}" if i % 5 else f"hot{i % 2}", i % 2) for i in range(1500)] + [(None, 0), ("x", None)], "ROW_ID string, y int")
    h = hash_hex(42, "ROW_ID")
    wanted = {"*": [0, lambda n: n // 3, lambda n: n // 2, lambda n: n - 1, lambda n: n]}
    got = ranks.hash_cuts(df, h, "ROW_ID", wanted, "y", digits, max_rows)
    own = {}
    for y, i, hx in df.select("y", "ROW_ID", h).collect():
        own.setdefault(y, []).append((hx is not None, hx or "", i))
    for y, ids in own.items():
        ids.sort(key=lambda x: x[:2])
        for cut in got[y]:
            if cut.rank < len(ids) and ids[cut.rank][0]:
                assert (cut.hash, cut.id) == ids[cut.rank][1:]
                assert cut.first == next(k for k, x in enumerate(ids) if x[2] == cut.id)
            else:
                assert cut.hash is None


def test_counts_of_a_split_are_few(spark):
    """The first count of a cut has no more buckets than a task needs: not nearly one a row."""
    df = spark.range(60_000).select(F.col("id").cast("string").alias("ROW_ID"), F.lit(1).alias("y"))
    assert 16**ranks.CUT_DIGITS * 10 < 60_000
    s = sampling.stratified_split(df, "y")
    assert s.where("IS_TEST = 1").count() == math.floor(0.3 * 60_000 + 0.5)


def test_score_batch_splits_once(spark, odd_dir, monkeypatch):
    calls = []
    keep = sampling.stratified_split
    monkeypatch.setattr(sampling, "stratified_split", lambda *a, **k: calls.append(1) or keep(*a, **k))
    catalog.REGISTRY["score_batch"](spark, odd_dir).count()
    assert len(calls) == 1


def test_method_limit(spark, odd_dir):
    try:
        spark.conf.unset(METHOD_LIMIT)
        training.split_features(spark, odd_dir, persist=False)
        assert spark.conf.get(METHOD_LIMIT) == "8000"
        spark.conf.set(METHOD_LIMIT, "20000")
        training.split_features(spark, odd_dir, persist=False)
        assert spark.conf.get(METHOD_LIMIT) == "20000"
    finally:
        spark.conf.unset(METHOD_LIMIT)
