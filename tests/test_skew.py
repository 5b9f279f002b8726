"""Hot keys: a third of all lines on one supplier, one customer and one day, and
a fifth of them sharing one line key. Results have to stay whole and exact,
also when nothing may be broadcast."""

from __future__ import annotations

import duckdb
import pytest

import __spark_entry__ as registered

SOURCE = "/root/testdata/sf0.001"
SMALL = ["customer", "supplier"]
HOT = [
    "q01_portfolio_kpi", "q05_state_breakdown", "q07_comorbidity_by_label", "q08_orphan_claims",
    "q09_long_stay_providers", "q12_payout_deciles_all", "q13_rolling_claim_average", "q14_same_day_billing",
    "q16_physician_churn", "e08_dedup_first", "e09_referential_filter", "f01_provider_features",
    "b04_temporal_trends", "b06_claims_drillthrough", "c03_foreign_keys_staged", "g03_provider_quadrant",
]


@pytest.fixture(scope="module")
def hot(spark, tmp_path_factory):
    folder = str(tmp_path_factory.mktemp("hot"))
    duck = duckdb.connect()
    for table in SMALL:
        duck.execute(f"COPY (SELECT * FROM '{SOURCE}/{table}.parquet') TO '{folder}/{table}.parquet' (FORMAT parquet)")
    duck.execute(
        f"COPY (SELECT * REPLACE (CASE WHEN o_orderkey % 3 = 0 THEN 7 ELSE o_custkey END AS o_custkey)"
        f" FROM '{SOURCE}/orders.parquet') TO '{folder}/orders.parquet' (FORMAT parquet)"
    )
    mixed = "(l_partkey * 31 + CAST(l_extendedprice * 100 AS BIGINT))"
    duck.execute(
        f"""COPY (SELECT * REPLACE (CASE WHEN {mixed} % 3 = 0 THEN 3 ELSE l_suppkey END AS l_suppkey,
          CASE WHEN {mixed} % 5 = 0 THEN 1 ELSE l_orderkey END AS l_orderkey,
          CASE WHEN {mixed} % 5 = 0 THEN 1 ELSE l_linenumber END AS l_linenumber,
          CASE WHEN l_partkey % 3 = 0 THEN TIMESTAMP '1998-03-04' ELSE l_shipdate END AS l_shipdate)
        FROM '{SOURCE}/lineitem.parquet') TO '{folder}/lineitem.parquet' (FORMAT parquet)"""
    )
    for table in [*SMALL, "orders", "lineitem"]:
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield folder, duck
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def same(value):
    return repr(round(value, 9)) if isinstance(value, float) else repr(value)


@pytest.mark.parametrize("name", HOT)
def test_hot_keys(spark, hot, name):
    folder, duck = hot
    result = duck.execute(registered.oracle_sql()[name])
    columns = [entry[0] for entry in result.description]
    expected = sorted(tuple(same(v) for v in row) for row in result.fetchall())
    got = registered.queries()[name](spark, folder).select(*columns).collect()
    assert sorted(tuple(same(v) for v in row) for row in got) == expected
