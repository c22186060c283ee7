"""Adapters from the star-schema test tables to the campaign's raw inputs.

`events` plays the event log, `customer` with `orders` the profiles, `part` the offer
catalogue. The mapping is arithmetic on keys, so SQL can state the same rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

# Only the columns the adapters read; a given schema spares the inference job.
_COLUMNS = {
    "customer": "c_custkey bigint, c_acctbal double, c_mktsegment string",
    "events": "ts timestamp_ntz, user_id bigint, event_type string, value double, props string",
    "orders": "o_orderkey bigint, o_custkey bigint, o_orderstatus string, "
    "o_orderdate timestamp_ntz",
    "part": "p_partkey bigint, p_size int",
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(_COLUMNS[name]).parquet(f"{sf_dir}/{name}.parquet")


def offers(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        table(spark, sf_dir, "part")
        .selectExpr(
            "cast(p_partkey as string) as id",
            "case p_partkey % 3 when 0 then 'bogo' when 1 then 'discount' "
            "else 'informational' end as offer_type",
            "cast(5 * (p_partkey % 4) as bigint) as min_value",
            "cast(3 + p_size % 8 as double) as duration",
            "cast(if(p_partkey % 3 = 2, 0, 2 + p_partkey % 9) as bigint) as discount_value",
            "if(p_partkey % 10 = 9, null, array_compact(array('email', "
            "if(p_partkey % 2 = 0, 'web', null), if(p_partkey % 3 <> 0, 'mobile', null), "
            "if(p_partkey % 5 < 3, 'social', null)))) as channels",
        )
    )


def profile(spark: SparkSession, sf_dir: str) -> DataFrame:
    first_order = (
        table(spark, sf_dir, "orders")
        .groupBy("o_custkey")
        .agg({"o_orderdate": "min"})
        .toDF("c_custkey", "first_order")
    )
    return (
        table(spark, sf_dir, "customer")
        .join(first_order, "c_custkey", "left")
        .selectExpr(
            "cast(if(c_custkey % 8 = 0, 118, 15 + c_custkey % 60) as bigint) as age",
            "if(c_acctbal > 0, c_acctbal, null) as credit_card_limit",
            "case c_mktsegment when 'MACHINERY' then ' m ' when 'FURNITURE' then 'F' "
            "when 'BUILDING' then 'O' when 'HOUSEHOLD' then 'x' end as gender",
            "cast(c_custkey as string) as id",
            "date_format(first_order, 'yyyyMMdd') as registered_on",
        )
    )


def transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All events; each customer has ten of the offers. `error` stays as a kind of its own."""
    # Answered from file footers, without reading the rows.
    n_offers = max(1, table(spark, sf_dir, "part").count())
    offer = f"cast((user_id * 10 + k % 10) % {n_offers} as string)"
    return (
        table(spark, sf_dir, "events")
        .selectExpr(
            "*",
            "cast(get_json_object(props, '$.k') as bigint) as k",
            "timestampdiff(MICROSECOND, timestamp_ntz'2024-01-01 00:00:00', ts) as t_us",
        )
        .selectExpr(
            "cast(user_id as string) as account_id",
            "case event_type when 'signup' then 'offer received' when 'view' then 'offer viewed' "
            "when 'click' then 'offer completed' when 'purchase' then 'transaction' "
            "else event_type end as event",
            "t_us / 86400e6D as time_since_test_start",
            "named_struct("
            "'amount', if(event_type = 'purchase', value, null), "
            f"'offer id', if(event_type in ('signup', 'view'), {offer}, null), "
            f"'offer_id', if(event_type = 'click', {offer}, null), "
            "'reward', if(event_type = 'click', cast(2 + k % 9 as double), null)) as value",
        )
    )


def scored(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Key, outcome and score from `orders`: many ties, no randomness."""
    return (
        table(spark, sf_dir, "orders")
        .selectExpr("o_orderkey as key", "cast(o_orderstatus <> 'O' as int) as y")
        .selectExpr(
            "key", "y", "cast(50 + (key * 7919) % 600 + 300 * y as double) / 1000 as score"
        )
    )
