"""Hand-made edge records: malformed JSON, unknown kinds, wrong types,
bad and NULL times, single readings, overflow, non-ASCII text."""

import datetime as dt
import json

from pyspark.sql import functions as F

from eventlens.contracts import CONTRACTS, split_lossy
from eventlens.operators import aggregates, bronze, derived, parse
from eventlens.sources.messages import encode_events

T0 = dt.datetime(2024, 1, 1, 0, 0, 0)


def msgs(spark, objs):
    rows = [(o if isinstance(o, str) else json.dumps(o, ensure_ascii=False), T0) for o in objs]
    return spark.createDataFrame(rows, "json string, kafka_timestamp timestamp")


def tx(i, **kw):
    base = {
        "transaction_id": f"t{i}",
        "user_id": "u1",
        "user_name": "Иван",
        "user_city": "Москва",
        "user_age": 30,
        "transaction_amount": 150.5,
        "transaction_category": "Книги",
        "transaction_date": "2024-01-01T00:10:00",
        "payment_method": "cash",
        "status": "success",
        "device": "mobile",
        "metadata": {"items_count": 2, "discount_applied": True, "loyalty_points_earned": 1},
        "data_type": "transaction",
        "batch_id": "batch_20240101_00",
    }
    base.update(kw)
    return base


def sensor(i, ts, status="warning", value=1.0, sid="sensor_0001"):
    return {
        "sensor_id": sid,
        "sensor_type": "temperature",
        "sensor_location": "office",
        "timestamp": ts,
        "value": value,
        "unit": "°C",
        "status": status,
        "battery_level": 50,
        "signal_strength": 3,
        "data_type": "sensor",
        "batch_id": "b",
    }


def test_malformed_missing_and_unknown_kinds_are_rejected(spark):
    m = msgs(spark, ["{not json", {"batch_id": "x"}, {"data_type": "other"}, tx(1)])
    p = parse.parsed(m)
    assert parse.route(p, "transaction").count() == 1
    rej = parse.rejected(p).collect()
    assert len(rej) == 3
    assert sorted(r.data_type or "" for r in rej) == ["", "", "other"]


def test_wrong_typed_field_becomes_null_rest_kept(spark):
    m = msgs(spark, [tx(1, user_age="abc", transaction_amount="oops")])
    r = parse.typed(m, "transaction").collect()[0]
    assert r.user_age is None and r.transaction_amount is None
    assert r.transaction_id == "t1" and r.user_city == "Москва"


def test_event_time_parsing(spark):
    times = ["2024-01-01T00:00:07.179575", "2024-01-01T00:00:07", "junk", "", None]
    m = msgs(spark, [tx(i, transaction_date=t) for i, t in enumerate(times)])
    got = {
        r.transaction_id: r.event_time
        for r in aggregates.prepare(m, "transaction").select("transaction_id", "event_time").collect()
    }
    assert got["t0"] == dt.datetime(2024, 1, 1, 0, 0, 7, 179575)
    assert got["t1"] == dt.datetime(2024, 1, 1, 0, 0, 7)
    assert got["t2"] is None and got["t3"] is None and got["t4"] is None


def test_null_event_time_vanishes_from_aggregates_but_not_raw(spark):
    m = msgs(spark, [tx(1), tx(2, transaction_date="junk")])
    a = aggregates.from_messages("transaction_hourly_stats", m).collect()
    assert len(a) == 1 and a[0].transaction_count == 1
    raw = parse.raw_from_messages(m, "raw_transactions")
    good, bad = split_lossy(raw, "raw_transactions")
    assert [r.transaction_id for r in good.collect()] == ["t1"]
    assert [(r.transaction_id, r.transaction_date) for r in bad.collect()] == [("t2", "junk")]


def test_single_reading_stddev_is_null(spark):
    m = msgs(spark, [sensor(1, "2024-01-01T00:01:00")])
    r = aggregates.from_messages("sensor_anomalies", m).collect()[0]
    assert r.reading_count == 1 and r.std_value is None
    assert str(r.avg_value) == "1.000"


def test_normal_readings_are_not_anomalies(spark):
    m = msgs(spark, [sensor(1, "2024-01-01T00:01:00", status="normal")])
    assert aggregates.from_messages("sensor_anomalies", m).count() == 0


def test_overflow_goes_to_quarantine_rest_written(spark):
    m = msgs(spark, [tx(1), tx(2, transaction_amount=1e15)])
    raw = parse.raw_from_messages(m, "raw_transactions")
    good, bad = split_lossy(raw, "raw_transactions")
    assert [r.transaction_id for r in good.collect()] == ["t1"]
    assert [r.transaction_id for r in bad.collect()] == ["t2"]


def test_overflowing_amount_is_skipped_by_sums(spark):
    m = msgs(spark, [tx(1), tx(2, transaction_amount=1e15)])
    r = aggregates.from_messages("payment_method_stats", m).collect()[0]
    assert r.transaction_count == 2 and str(r.total_amount) == "150.50"


def test_non_ascii_and_location_timezone(spark):
    act = {
        "activity_id": "a1",
        "user_id": "u1",
        "activity_type": "login",
        "timestamp": "2024-01-01T00:00:00",
        "session_duration": 2.5,
        "device_info": {"browser": "Chrome", "os": "iOS"},
        "location": {"city": "Санкт-Петербург", "country": "Russia", "timezone": "Europe/Moscow"},
        "data_type": "activity",
    }
    r = parse.raw_from_messages(msgs(spark, [act]), "raw_activities").collect()[0]
    assert r.location == '{"city":"Санкт-Петербург","country":"Russia"}'
    assert r.device_info == '{"browser":"Chrome","os":"iOS"}'
    assert r.session_duration is None  # 2.5 into an integer field


def test_encode_parse_round_trip(spark):
    df = spark.createDataFrame(
        [("Москва", 1.25, T0)], "user_city string, transaction_amount double, kafka_timestamp timestamp"
    ).withColumn("data_type", F.lit("transaction"))
    back = parse.typed(encode_events(df), "transaction").collect()[0]
    assert back.user_city == "Москва" and back.transaction_amount == 1.25


def test_bronze_matches_direct_parse(spark, tmp_dir):
    m = msgs(spark, [tx(1), tx(2, status="failed"), sensor(1, "2024-01-01T00:01:00"), "{bad"])
    bronze.write_bronze(m, tmp_dir)
    kinds = {r[0]: r[1] for r in spark.read.parquet(tmp_dir).groupBy("data_type").count().collect()}
    assert kinds == {"transaction": 2, "sensor": 1, bronze.REJECTED: 1}
    a = aggregates.build("device_stats", bronze.read_kind(spark, tmp_dir, "transaction")).collect()
    b = aggregates.from_messages("device_stats", m).collect()
    assert a == b


def test_contract_columns_declared_for_every_table():
    for name, c in CONTRACTS.items():
        assert set(c.key) <= set(c.names), name


def test_hot_user_with_a_third_of_rows_matches_brute_force(spark):
    """One user holds a third of all transactions; per-user spend per hour
    must equal a direct computation (partial aggregation, no row loss)."""
    import decimal

    objs = []
    for i in range(600):
        user = "hot" if i % 3 == 0 else f"u{i % 40}"
        minute = i % 180
        objs.append(
            tx(
                i,
                user_id=user,
                user_name=user,
                transaction_amount=float(100 + i % 17),
                transaction_date=f"2024-01-01T{minute // 60:02d}:{minute % 60:02d}:00",
            )
        )
    got = {
        (r.window_start.hour, r.user_id): (r.total_spent, r.transaction_count)
        for r in aggregates.from_messages("top_users", msgs(spark, objs)).collect()
    }
    want: dict = {}
    for o in objs:
        k = (int(o["transaction_date"][11:13]), o["user_id"])
        s, n = want.get(k, (decimal.Decimal("0.00"), 0))
        want[k] = (s + decimal.Decimal(str(o["transaction_amount"])).quantize(decimal.Decimal("0.01")), n + 1)
    assert got == want
    assert sum(n for (_, u), (_, n) in got.items() if u == "hot") == 200


def test_number_in_a_string_field_keeps_its_text(spark):
    m = msgs(spark, [tx(1, user_name=12345, merchant=1.5)])
    r = parse.typed(m, "transaction").collect()[0]
    assert r.user_name == "12345" and r.merchant == "1.5"


def test_points_beyond_an_int_are_null_and_never_consistent(spark):
    amounts = [150.5, 9e9, 2.1e11, 3e11, 1e15, 1e300, None]
    m = msgs(spark, [tx(i, transaction_amount=a) for i, a in enumerate(amounts)])
    got = {r.transaction_id: (r.expected_points, r.reported_points, r.consistent) for r in derived.loyalty_check(parse.typed(m, "transaction")).collect()}
    points = [1, 90_000_000, 2_100_000_000, None, None, None, None]
    assert got == {f"t{i}": (p, 1, p == 1) for i, p in enumerate(points)}
    huge = tx(0, transaction_amount=1e15, metadata={"items_count": 2, "discount_applied": True, "loyalty_points_earned": None})
    assert [r.consistent for r in derived.loyalty_check(parse.typed(msgs(spark, [huge]), "transaction")).collect()] == [False]
