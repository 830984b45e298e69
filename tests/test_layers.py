"""Both layers end to end over file topics."""

from __future__ import annotations

import json
import random
import time
from datetime import date, timedelta

import brute
from pyspark.sql import functions as F

from rillmark.operators import cdc
from rillmark.plans import order_layer, visitor_layer
from rillmark.sources import topics
from rillmark.sources.topics import Bus
from rillmark.streaming import jobs

NOW = {"availableNow": True}


def put(spark, root, topic, lines):
    topics.append_topic(spark.createDataFrame([(x,) for x in lines], "value string").coalesce(1), topic, root)
    time.sleep(0.05)


def test_visitor_layer(spark, tmp_path):
    root, rng = str(tmp_path / "bus"), random.Random(21)
    pages, lines, when = [], [], 1_700_000_000_000
    for i in range(90):
        when += rng.randrange(1000, 9000)
        mid, entry = f"m{rng.randrange(3)}", rng.random() < 0.6
        record = {"common": {"mid": mid, "is_new": "1", "vc": "v1", "ch": "c", "ar": "a"}, "ts": when}
        if i % 10 == 9:
            record["start"] = {"entry": "icon"}
        else:
            record["page"] = {"last_page_id": "" if entry else "p", "during_time": i}
            record["displays"] = [{"n": n} for n in range(i % 3)]
            pages.append((i, mid, when, entry))
        lines.append(json.dumps(record))
    shown = sum(i % 3 for i, *_ in pages)
    for part in range(0, 90, 30):
        put(spark, root, topics.RAW_LOG, [*lines[part:part + 30], "{damaged"])
    last = {"common": {"mid": "end", "is_new": "0", "vc": "end"}, "page": {"last_page_id": "p", "during_time": 0}, "ts": when + 10**9}
    put(spark, root, topics.RAW_LOG, [json.dumps(last)])

    bus = Bus(spark, root, per_batch=1)
    jobs.drain(visitor_layer.base_log(bus, **NOW))
    routed = lambda t: topics.topic_table(spark, t, f"{root}/{visitor_layer.ROUTER}", routed=True)
    assert [routed(t).count() for t in (topics.START_LOG, topics.PAGE_LOG, topics.DISPLAY_LOG, topics.DIRTY_LOG)] == [
        9, len(pages) + 1, shown, 3]
    flags = routed(topics.PAGE_LOG).unionByName(routed(topics.START_LOG)).select(
        F.get_json_object("value", "$.common.mid").alias("mid"), F.get_json_object("value", "$.common.is_new").alias("n"))
    assert sorted((r.mid, r.n) for r in flags.filter("n = '1'").collect()) == [("m0", "1"), ("m1", "1"), ("m2", "1")]

    # Order between topics is by event time here: all pages in one batch of the later jobs.
    bus = Bus(spark, root)
    jobs.drain(visitor_layer.unique_visitors(bus, ttl=None, **NOW))
    jobs.drain(visitor_layer.bounces(bus, delay=timedelta(days=1), **NOW))
    out = str(tmp_path / "stats")
    jobs.drain(visitor_layer.visitor_stats(bus, out, delay=timedelta(days=1), **NOW))
    table = visitor_layer.visitor_table(bus, out).filter("vc = 'v1'")
    uv, pv, sv, uj, dur = table.agg(*[F.sum(c) for c in ("uv_ct", "pv_ct", "sv_ct", "uj_ct", "dur_sum")]).first()
    days = {(mid, ts // 86_400_000) for _, mid, ts, _ in pages}
    assert (uv, pv, sv) == (len(days), len(pages), sum(e for *_, e in pages))
    assert dur == sum(i for i, *_ in pages)
    assert uj == len(brute.bounces([(i, m, t, e) for i, m, t, e in pages], 10_000))
    assert all(r.stt[-1] == "0" and r.stt < r.edt for r in table.collect())


def envelope(table, op, ts, row):
    image = {k: (v if v is None else str(v)) for k, v in row.items()}
    before, after = (image, None) if op == "DELETE" else (None, image)
    return json.dumps({"topic": f"server.shop.{table}", "op": op, "ts": ts, "before": before, "after": after})


ROUTES = [
    ("order_info", "insert", "kafka", topics.ORDER_INFO, "id,province_id,order_status,user_id,total_amount,original_total_amount,create_time", "id"),
    ("order_detail", "insert", "kafka", topics.ORDER_DETAIL, "id,order_id,sku_id,order_price,sku_num,sku_name,create_time,split_total_amount", "id"),
    ("payment_info", "insert", "kafka", topics.PAYMENT, "id,order_id,user_id,total_amount,subject,payment_type,create_time,callback_time", "id"),
    ("user_info", "insert", "hbase", "dim_user_info", "id,birthday,gender", "id"),
    ("user_info", "update", "hbase", "dim_user_info", "id,birthday,gender", "id"),
    ("base_province", "insert", "hbase", "dim_base_province", "id,name,area_code,iso_code,iso_3166_2", "id"),
    ("sku_info", "insert", "HBASE", "dim_sku_info", "id,sku_name,category3_id,spu_id,tm_id", "id"),
    ("spu_info", "insert", "hbase", "dim_spu_info", "id,spu_name", "id"),
    ("base_trademark", "insert", "hbase", "dim_base_trademark", "id,tm_name", "id"),
    ("base_category3", "insert", "hbase", "dim_base_category3", "id,name", "id"),
]


def test_order_layer(spark, tmp_path):
    root = str(tmp_path / "bus")
    config = spark.createDataFrame(
        [(*r, None, "insert", 1) for r in ROUTES], ", ".join(f"{c} string" for c in cdc.CONFIG_FIELDS) + ", type string, v int")
    put(spark, root, topics.RAW_CHANGES, [
        envelope("user_info", "CREATE", 1, {"id": 7, "birthday": "1990-11-02", "gender": "F", "phone": "x"}),
        envelope("base_province", "CREATE", 1, {"id": 3, "name": "P", "area_code": "11", "iso_code": "I", "iso_3166_2": "I2"}),
        envelope("sku_info", "CREATE", 1, {"id": 5, "sku_name": "S", "category3_id": 61, "spu_id": 51, "tm_id": 41}),
        envelope("spu_info", "CREATE", 1, {"id": 51, "spu_name": "SP"}),
        envelope("base_trademark", "CREATE", 1, {"id": 41, "tm_name": "TM"}),
        envelope("base_category3", "CREATE", 1, {"id": 61, "name": "C3"}),
        envelope("unknown", "CREATE", 1, {"id": 1}),
    ])
    put(spark, root, topics.RAW_CHANGES, [
        envelope("user_info", "UPDATE", 2, {"id": 7, "gender": "M"}),
        envelope("order_info", "CREATE", 2, {"id": 100, "province_id": 3, "order_status": "1", "user_id": 7, "total_amount": "12.50",
                                           "original_total_amount": "12.50", "create_time": "2021-11-02 10:00:00", "secret": "s"}),
        *[envelope("order_detail", "CREATE", 3, {"id": d, "order_id": 100, "sku_id": 5, "order_price": "6.25", "sku_num": 1,
                                               "sku_name": "old", "create_time": t, "split_total_amount": "6.25"})
          for d, t in ((1, "2021-11-02 10:00:05"), (2, "2021-11-02 10:00:06"))],
        *[envelope("payment_info", "CREATE", 4, {"id": p, "order_id": 100, "user_id": 8, "total_amount": "12.40", "subject": "sub",
                                               "payment_type": "card", "create_time": t, "callback_time": t})
          for p, t in ((900, "2021-11-02 10:15:00"), (901, "2021-11-02 10:16:00"))],
    ])
    bus, slack = Bus(spark, root, per_batch=1), timedelta(days=1)
    jobs.drain(order_layer.base_db(bus, lambda: config, ["v"], **NOW))
    assert spark.read.parquet(f"{root}/unrouted").count() == 1
    user = order_layer.dimension(bus, "dim_user_info", "id,birthday,gender").read().collect()
    assert [(r.pk, r.birthday, r.gender) for r in user] == [("7", "1990-11-02", "M")]

    def dims():
        read = lambda t, c: order_layer.dimension(bus, t, c).read()
        return {
            "users": read("dim_user_info", "id,birthday,gender"),
            "provinces": read("dim_base_province", "id,name,area_code,iso_code,iso_3166_2"),
            "skus": read("dim_sku_info", "id,sku_name,category3_id,spu_id,tm_id"),
            "spus": read("dim_spu_info", "id,spu_name"),
            "trademarks": read("dim_base_trademark", "id,tm_name"),
            "categories": read("dim_base_category3", "id,name"),
        }

    bus = Bus(spark, root)
    jobs.drain(order_layer.order_wide(bus, dims, date(2021, 11, 2), delay=slack, **NOW))
    jobs.drain(order_layer.payment_wide(bus, delay=slack, **NOW))
    rows = [json.loads(r.value) for r in topics.topic_table(spark, topics.PAYMENT_WIDE, root).collect()]
    assert len(rows) == 1
    want = {
        "payment_id": 900, "order_id": 100, "user_id": 8, "total_amount": 12.4, "order_total_amount": 12.5, "detail_id": 1,
        "sku_name": "S", "spu_name": "SP", "tm_name": "TM", "category3_name": "C3", "province_name": "P", "province_3166_2_code": "I2",
        "user_age": 31, "user_gender": "M", "order_create_time": "2021-11-02 10:00:00", "payment_create_time": "2021-11-02 10:15:00",
    }
    assert {k: rows[0].get(k) for k in want} == want
    assert "secret" not in rows[0]

    config = config.unionByName(spark.createDataFrame([(*ROUTES[7], None, "delete", 2)], config.schema))
    put(spark, root, topics.RAW_CHANGES, [envelope("spu_info", "CREATE", 5, {"id": 52, "spu_name": "late"})])
    jobs.drain(order_layer.base_db(Bus(spark, root), lambda: config, ["v"], **NOW))
    assert order_layer.dimension(bus, "dim_spu_info", "id,spu_name").read().count() == 0
