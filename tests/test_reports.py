"""Report post-processing and metamorphic relations between tables."""

from pyspark.sql import functions as F

from eventlens.functions.bands import kpi_band
from eventlens.plans import reports
from eventlens.plans.pipeline import AGGREGATE_TABLES, Pipeline
from eventlens.contracts import CONTRACTS
from tests.conftest import SF_SMALL


def test_kpi_band_steps_out_of_order(spark):
    df = spark.createDataFrame([(95.0,), (80.0,), (50.0,), (None,)], "v double")
    got = [r.b for r in df.select(kpi_band(F.col("v"), "avg_success_rate").alias("b")).collect()]
    assert got == ["green", "red", "blue", None]


def test_sums_agree_across_tables(spark):
    p = Pipeline.from_fixtures(spark, SF_SMALL)
    totals = [
        p.table(t).agg(F.sum("total_amount")).first()[0]
        for t in ("transaction_hourly_stats", "payment_method_stats", "hourly_metrics")
    ]
    totals.append(p.table("top_users").agg(F.sum("total_spent")).first()[0])
    assert len(set(totals)) == 1
    counts = [p.table(t).agg(F.sum("transaction_count")).first()[0] for t in ("device_stats", "payment_method_stats")]
    assert counts[0] == counts[1] == p.table("hourly_metrics").agg(F.sum("total_transactions")).first()[0]


def test_table_keys_are_unique(spark):
    p = Pipeline.from_fixtures(spark, SF_SMALL)
    for name in AGGREGATE_TABLES:
        key = list(CONTRACTS[name].key)
        dup = p.table(name).groupBy(*key).count().filter("count > 1").count()
        assert dup == 0, name


def test_sort_orders_of_panels(spark):
    p = Pipeline.from_fixtures(spark, SF_SMALL)
    city = [r.total for r in reports.rpt_amount_by_city(p).collect()]
    assert city == sorted(city, reverse=True)
    top = reports.rpt_top10_users(p).collect()
    assert len(top) == 10
    assert [r.total_spent for r in top] == sorted((r.total_spent for r in top), reverse=True)
    latest = reports.rpt_latest_anomalies(p).collect()
    assert [r.window_start for r in latest] == sorted((r.window_start for r in latest), reverse=True)


def test_last_range_uses_data_anchor(spark):
    p = Pipeline.from_fixtures(spark, SF_SMALL)
    series = reports.rpt_total_by_hour(p)
    last = reports.last_range(series, "time", 6).collect()
    assert 1 <= len(last) <= 6


def test_date_partitioned_recompute_is_pruned_and_idempotent(spark, tmp_dir):
    from eventlens.operators.bronze import write_bronze
    from eventlens.plans.pipeline import Tables
    from eventlens.sources.messages import stored_topic

    bronze = f"{tmp_dir}/bronze"
    write_bronze(stored_topic(spark, SF_SMALL), bronze, by_date=True)
    names = ("transaction_hourly_stats", "sensor_anomalies", "raw_sensors")
    root = f"{tmp_dir}/tables"
    Pipeline.from_bronze(spark, bronze).materialize(root, names, by_date=True)
    before = {n: sorted(map(tuple, Tables(spark, root).table(n).collect())) for n in names}

    days = ("2024-01-05", "2024-01-06")
    part = Pipeline.from_bronze(spark, bronze, days=days)
    plan = part.table("transaction_hourly_stats")._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan and "event_date" in plan.split("PartitionFilters")[1][:400]
    part.materialize(root, names, by_date=True)  # rewrite two days only
    after = {n: sorted(map(tuple, Tables(spark, root).table(n).collect())) for n in names}
    assert after == before

    full = Pipeline.from_fixtures(spark, SF_SMALL).table("transaction_hourly_stats")
    stored = Tables(spark, root).table("transaction_hourly_stats").drop("event_date")
    assert sorted(map(tuple, full.collect())) == sorted(map(tuple, stored.select(*full.columns).collect()))
