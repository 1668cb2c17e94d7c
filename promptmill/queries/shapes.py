"""The query shapes of the evaluation statements."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import shapes
from .registry import query, table


@query("SELECT count(*) AS total_suppliers FROM supplier")
def shape_q1(spark, folder):
    return shapes.count_rows(table(spark, folder, "supplier"), "total_suppliers")


@query("SELECT CAST(sum(CAST(l_quantity AS DECIMAL(18,2))) AS DOUBLE) AS total_quantity FROM lineitem")
def shape_q2(spark, folder):
    out = shapes.total(
        table(spark, folder, "lineitem"), F.col("l_quantity").cast("decimal(18,2)"), "total_quantity"
    )
    return out.select(F.col("total_quantity").cast("double"))


@query("SELECT CAST(sum(1) AS BIGINT) AS total_events FROM events")
def shape_q3(spark, folder):
    return shapes.count_ones(table(spark, folder, "events"), "total_events")


@query("SELECT count(DISTINCT l_partkey) AS distinct_parts FROM lineitem")
def shape_q4(spark, folder):
    return shapes.count_distinct(table(spark, folder, "lineitem"), "l_partkey", "distinct_parts")


@query("SELECT round(avg(c_acctbal), 4) AS average_balance FROM customer")
def shape_q5(spark, folder):
    out = shapes.average(table(spark, folder, "customer"), F.col("c_acctbal"), "a")
    return out.select(F.round("a", 4).alias("average_balance"))


@query("SELECT round(avg(l_extendedprice - l_tax), 4) AS average_difference FROM lineitem")
def shape_q6(spark, folder):
    out = shapes.average(table(spark, folder, "lineitem"), F.col("l_extendedprice") - F.col("l_tax"), "a")
    return out.select(F.round("a", 4).alias("average_difference"))


@query("SELECT CAST(min(o_orderdate) AS DATE) AS earliest_order FROM orders")
def shape_q7(spark, folder):
    out = shapes.earliest(table(spark, folder, "orders"), "o_orderdate", "earliest_order")
    return out.select(F.col("earliest_order").cast("date"))


@query("SELECT max(p_retailprice) AS highest_price FROM part")
def shape_q8(spark, folder):
    return shapes.highest(table(spark, folder, "part"), "p_retailprice", "highest_price")


@query(
    "SELECT c_mktsegment, round(avg(c_acctbal), 4) AS average_balance, "
    "round(avg(c_nationkey), 4) AS average_nation FROM customer GROUP BY c_mktsegment"
)
def shape_q9(spark, folder):
    out = shapes.averages_by(
        table(spark, folder, "customer"),
        "c_mktsegment",
        {"b": F.col("c_acctbal"), "n": F.col("c_nationkey")},
    )
    return out.select(
        "c_mktsegment", F.round("b", 4).alias("average_balance"), F.round("n", 4).alias("average_nation")
    )


@query(
    r"""SELECT CAST(sum(CAST(v AS DECIMAL(18,6))) AS DOUBLE) AS total_value FROM (
        SELECT CASE WHEN event_type = 'error' THEN props ELSE json_extract_string(props, '$.k') END AS v FROM events
    ) WHERE regexp_matches(v, '^[0-9]+(\.[0-9]+)?$')"""
)
def shape_q10(spark, folder):
    value = F.when(F.col("event_type") == "error", F.col("props")).otherwise(
        F.get_json_object("props", "$.k")
    )
    out = shapes.total_of_number_text(
        table(spark, folder, "events").select(value.alias("v")), F.col("v"), "total_value"
    )
    return out.select(F.col("total_value").cast("double"))
