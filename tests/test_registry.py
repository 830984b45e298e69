"""Every registered query against its SQL twin, and again with the skew paths forced."""

from __future__ import annotations

import oracle
import pytest
from pyspark.errors import AnalysisException

from rillmark.plans.batch_queries import BATCH
from rillmark.plans.layer_queries import LAYER_ORACLES, LAYERS
from rillmark.plans.oracles import ORACLES
from rillmark.plans.source_queries import SOURCE_ORACLES, SOURCES
from rillmark.plans.state_queries import STATE, STATE_ORACLES
from rillmark.plans.stream_queries import STREAM

SKEWED = [
    "visitor_stats", "new_visitor_repair", "new_visitor_repair_seeded", "daily_unique_change", "bounce_detection",
    "delta_alert", "delta_alert_first", "order_wide_interval", "payment_wide", "dim_lookup_missing_left",
    "dim_lookup_missing_inner", "running_sum", "running_max_by", "running_reduce_max", "running_max_field",
    "session_window", "count_window", "late_classify", "cdc_route_dim", "key_list_lookup",
]

QUERIES = {**BATCH, **STREAM, **STATE, **LAYERS, **SOURCES}


@pytest.fixture(scope="session")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(name, spark, sf_dir, con):
    got = oracle.spark_bag(QUERIES[name](spark, sf_dir))
    assert oracle.difference(got, oracle.sql_bag(con, {**ORACLES, **SOURCE_ORACLES, **STATE_ORACLES, **LAYER_ORACLES}[name])) is None


@pytest.mark.parametrize("name", SKEWED)
def test_skew_path_matches_sql(name, tight, sf_dir, con):
    got = oracle.spark_bag(BATCH[name](tight, sf_dir))
    assert oracle.difference(got, oracle.sql_bag(con, ORACLES[name])) is None


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(BATCH)))
def test_query_needs_no_number_of_partitions(name, spark, tmp_path):
    """A session that sets none gets as far as the tables, here missing ones, and still sets none."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.unset(key)
    try:
        with pytest.raises(AnalysisException, match="PATH_NOT_FOUND"):
            QUERIES[name](spark, str(tmp_path)).collect()
        assert spark.conf.get(key, None) is None
    finally:
        spark.conf.set(key, before)


def test_entry_contract(spark):
    import __spark_entry__ as contract

    assert contract.entry(spark).columns[:2] == ["stt", "edt"]
    assert set(contract.oracle_sql()) <= set(contract.queries())
