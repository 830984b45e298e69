"""Golden rows worked out by hand from the two demo files and single cases."""

from __future__ import annotations

from datetime import date, timedelta

import pandas as pd
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rillmark.functions import udfs
from rillmark.functions.text import camel_columns, java_split, join_key, snake_to_camel, string_hash, utf16_length
from rillmark.functions.times import age_on, datetime_to_millis, millis_to_datetime
from rillmark.operators import aggregates, cdc, distribution, joins, keyed, records, windows
from rillmark.sources import tables

READINGS = [
    (1, "user_1", 20.0, 1626683101), (2, "user_2", 27.0, 1626683102), (3, "user_3", 41.0, 1626683104),
    (4, "user_1", 30.0, 1626683103), (5, "user_1", 10.0, 1626683107), (6, "user_1", 40.0, 1626683105),
    (7, "user_1", 60.0, 1626683111), (8, "user_1", 70.0, 1626683112),
]
PHONES = [(1, "mi", 5000.3), (2, "huawei", 6000.1), (3, "apple", 7000.2), (4, "mi", 4000.5), (5, "mi", 6000.5), (6, "mi", 7000.7)]


@pytest.fixture
def readings(spark):
    df = spark.createDataFrame(READINGS, "seq int, name string, temperature double, time bigint")
    return df.withColumn("ts", F.timestamp_seconds("time"))


@pytest.fixture
def phones(spark):
    return spark.createDataFrame(PHONES, "seq int, phone string, price double")


def test_window_minimum_count_average(readings):
    w = windows.tumbling("ts", timedelta(seconds=10))
    rows = readings.withColumn("w", F.unix_seconds(w["start"]))
    low = aggregates.first_row_per_group(rows, ["name", "w"], [F.col("temperature"), F.col("seq")])
    assert sorted((r.name, r.w, r.temperature, r.time) for r in low.collect()) == [
        ("user_1", 1626683100, 10.0, 1626683107), ("user_1", 1626683110, 60.0, 1626683111),
        ("user_2", 1626683100, 27.0, 1626683102), ("user_3", 1626683100, 41.0, 1626683104)]
    stats = rows.groupBy("name", "w").agg(F.count("*").alias("n"), F.avg("temperature").alias("mean"))
    assert sorted(tuple(r) for r in stats.collect()) == [
        ("user_1", 1626683100, 4, 25.0), ("user_1", 1626683110, 2, 65.0), ("user_2", 1626683100, 1, 27.0),
        ("user_3", 1626683100, 1, 41.0)]


@pytest.mark.parametrize(
    "baseline,want",
    [("previous", [(20, 30), (30, 10), (10, 40), (40, 60), (60, 70)]), ("first", [(20, 30), (20, 10), (20, 40), (20, 60), (20, 70)])],
)
def test_delta_alerts(readings, baseline, want):
    got = keyed.delta_alerts(readings, "name", "temperature", 10, ["seq"], baseline).orderBy("seq").collect()
    assert [(r.last_value, r.temperature) for r in got] == want


def test_running_maximum(phones):
    best = aggregates.running_best_row(phones, ["phone"], "price", ["seq"], ["seq", "price"]).orderBy("seq").collect()
    want = [5000.3, 6000.1, 7000.2, 5000.3, 6000.5, 7000.7]
    assert [r.best.price for r in best] == want
    top = aggregates.running_maximum(phones, ["phone"], "price", ["seq"], "top").orderBy("seq").collect()
    assert [r.top for r in top] == want


def test_running_maximum_keeps_first_of_equals(spark):
    ties = spark.createDataFrame([(1, "a", 5.0), (2, "a", 5.0), (3, "a", None), (4, "a", 4.0)], "seq int, k string, v double")
    for hot in ("1000", "1"):
        spark.conf.set("rillmark.hotRows", hot)
        rows = aggregates.running_best_row(ties, ["k"], "v", ["seq"], ["seq"]).orderBy("seq").collect()
        assert [r.best.seq for r in rows] == [1, 1, 1, 1]
    spark.conf.unset("rillmark.hotRows")


def test_average_accumulator(readings):
    got = {r.name: round(r.average, 3) for r in udfs.average(readings, "name", "temperature").collect()}
    assert got == {"user_1": 38.333, "user_2": 27.0, "user_3": 41.0}


def test_string_hash(spark):
    df = spark.createDataFrame([("user_1",), ("user_2",), ("user_3",), ("",), ("a\U0001F600b",)], "s string")
    got = [(r[0], r[1]) for r in df.select(string_hash(F.col("s")), string_hash(F.col("s"), 10)).collect()]
    assert got[:3] == [(-836030275, 229631842), (-836030274, 229631852), (-836030273, 229631862)]
    assert got[3] == (0, 0)
    assert got[4][0] == udfs._hash32("a\U0001F600b", 1)


def test_split_rows(readings):
    rows = joins.split_rows(readings.select("seq", "name"), "name", "_").collect()
    assert sorted({(r.word, r.length) for r in rows}) == [("1", 1), ("2", 1), ("3", 1), ("user", 4)]
    assert len(rows) == 16


def test_java_split(spark):
    texts = ["user_1", "a__", "_", "", "_a"]
    df = spark.createDataFrame([(t,) for t in texts], "s string")
    got = [r[0] for r in df.select(java_split(F.col("s"), "_")).collect()]
    assert got == [["user", "1"], ["a"], [], [""], ["", "a"]]
    marks = spark.createDataFrame([("ABC\u00015093\u0001x",)], "s string").select(F.size(java_split(F.col("s"), "\u0001")))
    assert marks.first()[0] == 3


def test_dates(spark):
    one = spark.range(1)
    assert one.select(datetime_to_millis(F.lit("2021-11-02 15:23:00"), "+08:00")).first()[0] == 1635837780000
    assert one.select(millis_to_datetime(F.lit(1635837780000), "+08:00")).first()[0] == "2021-11-02 15:23:00"
    ages = spark.createDataFrame([("1990-11-02",), ("1990-11-03",), ("2022-01-01",), ("bad",), (None,)], "b string")
    got = [r[0] for r in ages.select(age_on(F.col("b"), date(2021, 11, 2))).collect()]
    assert got == [31, 30, None, None, None]


def test_small_functions(spark):
    assert [snake_to_camel(n) for n in ("order_id", "ISO_CODE", "a")] == ["orderId", "isoCode", "a"]
    assert camel_columns(spark.range(1).toDF("row_id")).columns == ["rowId"]
    text = spark.createDataFrame([("a\U0001F600",)], "s string")
    assert text.select(utf16_length(F.col("s"))).first()[0] == 3
    parts = spark.range(1).select(
        join_key(F.array(F.lit("a"), F.lit("b"))), join_key(F.array(F.lit("a"), F.lit(None).cast("string")))).first()
    assert tuple(parts) == ("a-b", None)


def test_interval_bounds(spark):
    orders = spark.createDataFrame([(1, 100)], "o int, osec bigint").withColumn("ots", F.timestamp_seconds("osec"))
    details = spark.createDataFrame([(1, 100 + d, d) for d in (-6, -5, 0, 5, 6)], "d int, dsec bigint, delta int")
    details = details.withColumn("dts", F.timestamp_seconds("dsec"))
    five = timedelta(seconds=5)
    got = joins.interval_join(orders, details, [("o", "d")], "ots", "dts", -five, five)
    assert sorted(r.delta for r in got.collect()) == [-5, 0, 5]


def test_log_cases(spark):
    lines = [
        '{"common":{"mid":"m","is_new":"1"},"start":{"e":1},"displays":[{"i":1}],"ts":1}',
        '{"common":{"mid":"m"},"page":{"last_page_id":"p"},"displays":[{"i":1},{"i":2}],"ts":2}',
        '{"common":{"mid":"m"},"page":{},"displays":[],"ts":3}',
        '{"common":{"mid":"m"},"page":{},"start":null,"ts":4}',
        '{"common":{"mid":"m"},"page":{},"start":"","ts":5}',
        "{broken", "", "12", '{"common":{}}', None,
    ]
    parsed = records.parse_logs(spark.createDataFrame([(x,) for x in lines], "value string"), "value")
    reasons = sorted(r.reason for r in records.dirty_logs(parsed).collect())
    assert reasons == ["bad_json", "bad_json", "bad_json", "no_mid", "not_an_object"]
    tagged = records.tag_logs(records.good_logs(parsed))
    assert [r.kind for r in tagged.orderBy("ts_ms").collect()] == ["start", "page", "page", "page", "page"]
    assert sorted(r.ts for r in records.page_displays(tagged).collect()) == [2, 2]


def test_delimited_lines(spark):
    schema = T.StructType([T.StructField("n", T.StringType()), T.StructField("t", T.DoubleType())])
    df = spark.createDataFrame([("a,1.5",), ("a",), ("a,x",), (None,)], "line string")
    got = [(r.n, r.t, r.dirty) for r in records.parse_delimited(df, "line", schema).collect()]
    assert got == [("a", 1.5, False), ("a", None, True), ("a", None, True), (None, None, True)]


def test_order_wide_has_all_columns(spark):
    from rillmark.plans import stand_ins as sample
    from rillmark.plans.batch_queries import _order_wide

    sf = "/root/testdata/sf0.001"
    wide = joins.enrich_order_wide(_order_wide(spark, sf), asof=sample.ASOF, **sample.dimensions(spark, sf))
    assert len(wide.columns) == 35 and len(set(wide.columns)) == len(wide.columns)
    payment = records.payment_wide_columns(
        joins.interval_join(
            records.prefixed(sample.payment_info(spark, sf), "p_"),
            records.prefixed(wide.withColumn("ts", F.to_timestamp("create_time")), "w_"),
            [("p_order_id", "w_order_id")], "p_ts", "w_ts", -timedelta(minutes=15), timedelta(0)))
    assert {"payment_id", "order_total_amount", "category3_name"} <= set(payment.columns)
    assert "create_time" not in payment.columns


def test_envelopes(spark):
    rows = [
        ("s.db.t", "CREATE", 1, None, {"a": "1"}), ("s.db.t", "d", 2, {"a": "1"}, None),
        ("s.db.t", "UPDATE", 3, {"a": "1"}, {"a": "2"}), ("s.db.t", "READ", 4, None, {"a": "3"}),
    ]
    df = spark.createDataFrame(rows, cdc.ENVELOPE)
    got = [(r.database, r.table, r.type, r.data) for r in cdc.normalise_changes(df).orderBy("ts").collect()]
    assert got == [("db", "t", "insert", {"a": "1"}), ("db", "t", "delete", {"a": "1"}), ("db", "t", "update", {"a": "2"}),
                   ("db", "t", "read", {"a": "3"})]
    both = cdc.normalise_changes(df, "both").orderBy("ts").collect()
    assert [(r.before_data, r.after_data) for r in both[:2]] == [({}, {"a": "1"}), ({"a": "1"}, {})]
    assert cdc.normalise_changes(df, "after").orderBy("ts").collect()[1].data is None


def test_config_lifecycle(spark):
    rows = [
        ("t", "insert", "HBASE", "dim_t", "id,name", "id", None, "insert", 1),
        ("t", "update", "hbase", "dim_t", "id,name", "id", None, "insert", 2),
        ("t", "insert", "HBASE", "dim_t", "id,name", "id", None, "delete", 3),
        ("u", "insert", "hbase", "dim_u", "id", "id", None, "insert", 4),
        ("u", "insert", "hbase", "dim_u", "id", "id", None, "delete", 5),
    ]
    fields = ", ".join(f"{c} string" for c in cdc.CONFIG_FIELDS)
    changes = spark.createDataFrame(rows, f"{fields}, type string, v int")
    live = cdc.config_state(changes, ["v"])
    assert [(r.sourceTable, r.operateType) for r in live.collect()] == [("t", "update")]
    assert sorted(tuple(r) for r in cdc.sink_tables(changes, live).collect()) == [("dim_t", "create"), ("dim_u", "drop")]
    assert cdc.sink_schema({"sinkColumns": "id,name"}) == "pk string, `id` string, `name` string"


def test_merge_rows_repeated_key(spark):
    a = spark.createDataFrame([(1, None, "x"), (1, 5, "y")], "k int, v int, w string")
    b = spark.createDataFrame([(1, 9, "z"), (2, 7, None)], "k int, v int, w string")
    got = joins.merge_rows([a.withColumn("n", F.lit(1)), b.withColumn("n", F.lit(2))], ["k"], ["n"])
    rows = {r.k: (r.v, r.w is not None) for r in got.collect()}
    assert rows == {1: (5, True), 2: (7, False)}


def test_key_list_lookup(spark):
    index = spark.createDataFrame([("a", "1,2"), ("b", "1")], "i string, f string")
    table = spark.createDataFrame([("1", "c1"), ("2", "c2"), ("3", "c2")], "id string, c string")
    assert {r.lookup_key: r.c for r in joins.key_list_lookup(index, "f", table, "id").collect()} == {"1": "c1", "2": "c2"}


def test_spreading_keeps_rows(spark):
    df = spark.range(1000).withColumn("w", F.when(F.col("id") % 7 == 0, "hit").otherwise("miss"))
    want = sorted(r.id for r in df.collect())
    for out in (
        distribution.shuffle_random(df, 5), distribution.rebalance(df, 3), distribution.rescale(df, 2),
        distribution.gather(df), distribution.by_key(df, 4, "id", "w"), distribution.pin_matching(df, 4, F.col("w") == "hit", ["id"]),
    ):
        assert sorted(r.id for r in out.collect()) == want
    pinned = records.add_partition_id(distribution.pin_matching(df, 4, F.col("w") == "hit", ["id"]))
    assert {r.task for r in pinned.filter("w = 'hit'").select("task").distinct().collect()} == {0}
    assert distribution.gather(df).rdd.getNumPartitions() == 1


def test_files_and_views(spark, tmp_path):
    (tmp_path / "u.txt").write_text("\n".join(f"{n},{t},{s}" for _, n, t, s in READINGS))
    df = tables.csv_table(spark, str(tmp_path / "u.txt"), "name string, temperature double, time bigint", "users_v")
    assert spark.sql("select * from users_v").count() == 8
    assert tables.text_lines(spark, str(tmp_path / "u.txt")).count() == 8
    tables.write_csv(df, str(tmp_path / "out"))
    assert tables.csv_table(spark, str(tmp_path / "out"), "name string, temperature double, time bigint").count() == 8
    renamed = tables.query_rows(spark, "select name as user_name from users_v", camel=True)
    assert renamed.columns == ["userName"]
    assert tables.from_rows(spark, [(1,), (2,)], "n int").count() == 2
    assert "p" in records.add_processing_time(df).columns


def test_resource_lifecycle(spark):
    out = udfs.map_with_resource(
        spark.range(10), lambda: [1], lambda r, b: pd.DataFrame({"id": b["id"] + r[0]}), lambda r: r.clear(), "id long")
    assert sorted(r.id for r in out.collect()) == list(range(1, 11))


def test_catalogued_table(spark, tmp_path):
    schema = "name string, temperature double"
    table = tables.catalog_csv_table(spark, "rillmark_output", str(tmp_path / "t"), schema)
    try:
        tables.insert_into(spark.createDataFrame([("a", 1.5), ("b", 2.0)], schema), "rillmark_output")
        assert sorted(tuple(r) for r in spark.table("rillmark_output").collect()) == [("a", 1.5), ("b", 2.0)]
        assert table.schema.simpleString() == "struct<name:string,temperature:double>"
    finally:
        spark.sql("drop table rillmark_output")


def test_task_counter(spark):
    rows = aggregates.partition_running_counter(spark.range(0, 10, 1, 2)).collect()
    assert [r.n for r in rows] == [1, 2, 3, 4, 5] * 2


def test_last_price_upsert(phones, tmp_path, spark):
    from rillmark.streaming.snapshot import KeyedSnapshot

    held = KeyedSnapshot(spark, str(tmp_path / "s"), ["phone"], "phone string, price double")
    held.upsert(phones.withColumn("type", F.lit("update")), 0, ["seq"])
    assert {r.phone: r.price for r in held.read().collect()} == {"mi": 7000.7, "huawei": 6000.1, "apple": 7000.2}
