"""The driver tables seen as warehouse records: devices, orders, details, payments, changes."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from rillmark.functions.json import evaluate_once
from rillmark.functions.times import DATETIME_FORMAT

ASOF = date(2021, 11, 2)
BOUNCE = timedelta(hours=12)
MONEY = "decimal(18,2)"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """A driver table. Its zone-less times are read as UTC, so the session is set to UTC."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def entry_event() -> Column:
    """An event that opens a visit: stands for an empty ``last_page_id``."""
    return F.col("event_type") == "signup"


def events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("ts", F.col("ts").cast("timestamp"))


def visits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Events with visitor dimensions, the new-visitor claim and a whole-number dwell time."""
    kind = F.col("event_type")
    return as_visits(events(spark, sf_dir)).withColumns({"vc": kind, "ch": kind, "ar": kind})


def as_visits(df: DataFrame) -> DataFrame:
    return df.withColumns(
        {
            "is_new": F.when(entry_event(), "1").otherwise("0"),
            "during_time": F.round(F.col("value") * 100).cast("bigint"),
        }
    )


def log_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return log_text_of(events(spark, sf_dir))


def log_text_of(e: DataFrame) -> DataFrame:
    """``event_id, value``: raw log JSON per event; some lines are damaged in four ways."""
    n = F.col("event_id")
    common = F.create_map(
        F.lit("mid"), F.col("user_id").cast("string"),
        F.lit("is_new"), F.when(entry_event(), "1").otherwise("0"),
        F.lit("vc"), F.col("event_type"),
    )
    page = F.struct(
        F.when(~entry_event(), F.concat(F.lit("page_"), (n % 9).cast("string"))).alias("last_page_id"),
        F.round(F.col("value") * 100).cast("bigint").alias("during_time"),
    )
    is_start = F.col("event_type") == "error"
    displays = F.when(n % 4 > 0, F.transform(F.sequence(F.lit(1), n % 4), lambda i: F.struct((n * 10 + i).alias("item"))))
    doc = F.struct(
        F.when(n % 101 != 7, common).alias("common"),
        F.when(~is_start, page).alias("page"),
        F.when(is_start, F.struct(F.lit("icon").alias("entry"))).alias("start"),
        F.when(~is_start, displays).alias("displays"),
        F.unix_millis("ts").alias("ts"),
    )
    good = F.to_json(doc)
    value = (
        F.when(n % 101 == 3, F.expr("substr(g, 1, 20)"))
        .when(n % 101 == 4, "")
        .when(n % 101 == 5, n.cast("string"))
        .otherwise(F.col("g"))
    )
    return evaluate_once(e, g=good).select("event_id", value.alias("value"))


def order_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_info_of(table(spark, sf_dir, "orders"))


def order_info_of(orders: DataFrame) -> DataFrame:
    """Orders in the order-info shape; amounts without a source column stay zero or NULL."""
    price, zero = F.col("o_totalprice").cast(MONEY), F.lit(0).cast(MONEY)
    when = F.col("o_orderdate").cast("timestamp")
    text = F.date_format(when, DATETIME_FORMAT)
    return orders.select(
        F.col("o_orderkey").alias("id"),
        (F.col("o_custkey") % 25).alias("province_id"),
        F.col("o_orderstatus").alias("order_status"),
        F.col("o_custkey").alias("user_id"),
        price.alias("total_amount"),
        zero.alias("activity_reduce_amount"),
        zero.alias("coupon_reduce_amount"),
        price.alias("original_total_amount"),
        zero.alias("feight_fee"),
        F.lit(None).cast("string").alias("expire_time"),
        text.alias("create_time"),
        text.alias("operate_time"),
        when.alias("ts"),
    )


def order_detail(spark: SparkSession, sf_dir: str) -> DataFrame:
    return order_detail_of(table(spark, sf_dir, "lineitem"))


def order_detail_of(lines: DataFrame) -> DataFrame:
    return lines.select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("l_partkey").alias("sku_id"),
        F.col("l_extendedprice").cast(MONEY).alias("order_price"),
        F.col("l_quantity").cast("bigint").alias("sku_num"),
        F.lit(None).cast("string").alias("sku_name"),
        F.col("l_extendedprice").cast(MONEY).alias("split_total_amount"),
        F.col("l_discount").cast(MONEY).alias("split_activity_amount"),
        F.col("l_tax").cast(MONEY).alias("split_coupon_amount"),
        F.col("l_shipdate").cast("timestamp").alias("ts"),
    )


def payment_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return payment_info_of(table(spark, sf_dir, "orders"))


def payment_info_of(orders: DataFrame) -> DataFrame:
    """One payment per finished order, up to 29 minutes after it."""
    finished = orders.filter("o_orderstatus = 'F'")
    paid = F.col("o_orderdate").cast("timestamp") + F.make_dt_interval(mins=(F.col("o_orderkey") % 30).cast("int"))
    return finished.select(
        F.col("o_orderkey").alias("id"),
        F.col("o_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("o_totalprice").cast(MONEY).alias("total_amount"),
        F.col("o_orderpriority").alias("subject"),
        F.lit("card").alias("payment_type"),
        F.date_format(paid, DATETIME_FORMAT).alias("create_time"),
        F.date_format(paid, DATETIME_FORMAT).alias("callback_time"),
        paid.alias("ts"),
    )


def dimensions(spark: SparkSession, sf_dir: str) -> dict[str, DataFrame]:
    """The six dimensions with their string columns and ``pk``."""
    customer, part = table(spark, sf_dir, "customer"), table(spark, sf_dir, "part")
    nation, region = table(spark, sf_dir, "nation"), table(spark, sf_dir, "region")
    supplier = table(spark, sf_dir, "supplier")
    birthday = F.date_add(F.lit(date(1960, 1, 1)), (F.col("c_custkey") % 15000).cast("int"))
    return {
        "users": customer.select(
            F.col("c_custkey").alias("pk"),
            birthday.cast("string").alias("birthday"),
            F.when(F.col("c_custkey") % 2 == 0, "F").otherwise("M").alias("gender"),
        ),
        "provinces": nation.join(region, F.col("n_regionkey") == F.col("r_regionkey"), "left").select(
            F.col("n_nationkey").cast("bigint").alias("pk"),
            F.col("n_name").alias("name"),
            F.col("n_regionkey").cast("string").alias("area_code"),
            F.concat(F.lit("N"), F.col("n_nationkey")).alias("iso_code"),
            F.col("r_name").alias("iso_3166_2"),
        ),
        "skus": part.select(
            F.col("p_partkey").alias("pk"),
            F.col("p_name").alias("sku_name"),
            F.col("p_size").cast("string").alias("category3_id"),
            (F.col("p_partkey") % 100).cast("string").alias("spu_id"),
            F.substring_index("p_brand", "#", -1).alias("tm_id"),
        ),
        "spus": supplier.select(F.col("s_suppkey").alias("pk"), F.col("s_name").alias("spu_name")),
        "trademarks": part.select("p_brand").distinct().select(
            F.substring_index("p_brand", "#", -1).cast("bigint").alias("pk"), F.col("p_brand").alias("tm_name")
        ),
        "categories": part.select("p_size").distinct().select(
            F.col("p_size").cast("bigint").alias("pk"), F.concat(F.lit("Size "), F.col("p_size")).alias("name")
        ),
    }


def change_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    return change_text_of(table(spark, sf_dir, "orders"))


def change_text_of(orders: DataFrame) -> DataFrame:
    """``o_orderkey, value``: envelope JSON per order; one table per status."""
    n = F.col("o_orderkey")
    image = F.create_map(
        F.lit("o_orderkey"), n.cast("string"),
        F.lit("o_custkey"), F.col("o_custkey").cast("string"),
        F.lit("o_orderstatus"), F.col("o_orderstatus"),
        F.lit("o_totalprice"), F.col("o_totalprice").cast(MONEY).cast("string"),
    )
    op = F.when(n % 10 == 0, "DELETE").when(n % 10 < 4, "UPDATE").otherwise("CREATE")
    envelope = F.struct(
        F.concat(F.lit("server1.shop.orders_"), F.lower("o_orderstatus")).alias("topic"),
        op.alias("op"),
        F.unix_millis(F.col("o_orderdate").cast("timestamp")).alias("ts"),
        F.when(op != "CREATE", image).alias("before"),
        F.when(op != "DELETE", image).alias("after"),
    )
    return evaluate_once(orders, value=F.to_json(envelope)).select(n, "value")


ROUTES = [
    ("orders_f", "insert", "kafka", "dwd_orders_f", "o_orderkey,O_TOTALPRICE", "o_orderkey", None),
    ("orders_o", "insert", "HBASE", "dim_orders_o", "o_orderkey,o_orderstatus", "o_custkey,o_orderkey", None),
    ("orders_p", "insert", "clickhouse", "ads_orders_p", "o_orderkey", "o_orderkey", None),
    ("orders_f", "update", "hbase", "dim_orders_f", "o_orderkey", "", None),
    ("orders_o", "update", "kafka", "dwd_orders_o", "o_orderkey,o_custkey", "o_orderkey", None),
    ("orders_p", "update", "hbase", "dim_orders_p", "o_orderkey", "o_missing", None),
    ("orders_f", "delete", "hbase", "dim_orders_f", "o_orderkey,o_custkey", "o_orderkey", None),
]


def routes(spark: SparkSession) -> DataFrame:
    from rillmark.operators.cdc import CONFIG_FIELDS

    return spark.createDataFrame(ROUTES, ", ".join(f"{c} string" for c in CONFIG_FIELDS))


def yearly_routes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration that changes while orders arrive: one record per table, operation and year of its orders.

    It is created in the first year, updated in most others and deleted in
    every fourth, in the middle of a month that depends on the year.
    """
    years = table(spark, sf_dir, "orders").select(F.lower("o_orderstatus").alias("s"), F.year("o_orderdate").alias("y")).distinct()
    rows = years.select("*", F.explode(F.array(*[F.lit(o) for o in ("insert", "update", "delete")])).alias("operateType"))
    target = F.concat_ws("_", F.lit("t"), "s", "operateType", "y")
    return rows.select(
        F.concat(F.lit("orders_"), "s").alias("sourceTable"),
        "operateType",
        F.when(F.col("y") % 2 == 0, "HBASE").otherwise("kafka").alias("sinkType"),
        target.alias("sinkTable"),
        F.lit("o_orderkey,O_CUSTKEY").alias("sinkColumns"),
        F.when(F.col("y") % 5 == 0, "o_custkey,o_orderkey").otherwise("o_orderkey").alias("sinkPk"),
        F.when(F.col("y") % 4 == 3, "delete").otherwise("update").alias("type"),
        F.make_date("y", F.col("y") % 12 + 1, F.lit(15)).cast("timestamp").alias("ts"),
    )


def config_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Configuration change feed: one record per part, keyed by brand and type."""
    n = F.col("p_partkey")
    return table(spark, sf_dir, "part").select(
        F.col("p_brand").alias("sourceTable"),
        F.col("p_type").alias("operateType"),
        F.when(n % 3 == 0, "kafka").otherwise("hbase").alias("sinkType"),
        F.concat(F.lit("dim_"), F.lower("p_brand"), F.lit("_"), (n % 2).cast("string")).alias("sinkTable"),
        F.lit("id,name").alias("sinkColumns"),
        F.lit("id").alias("sinkPk"),
        F.lit(None).cast("string").alias("sinkExtend"),
        F.when(n % 5 == 0, "delete").when(n % 5 == 1, "update").otherwise("insert").alias("type"),
        n.alias("version"),
    )


def customer_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return customer_changes_of(table(spark, sf_dir, "orders"))


def customer_changes_of(orders: DataFrame) -> DataFrame:
    """Partial-column changes keyed by customer: every third order tells the status only."""
    n = F.col("o_orderkey")
    return orders.select(
        "o_custkey",
        n.alias("version"),
        F.when(n % 10 == 0, "delete").when(n % 10 < 4, "update").otherwise("insert").alias("type"),
        F.when(n % 3 == 0, F.col("o_orderstatus")).alias("status"),
        F.when(n % 3 != 0, F.col("o_totalprice")).alias("price"),
    )
