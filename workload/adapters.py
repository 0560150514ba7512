"""The test tables in the roles of a document source (parents, teams, attributes)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# The load times of the queries.
T0 = "1998-01-01 00:00:00"
T1 = "1998-07-01 00:00:00"
T2 = "1999-01-01 00:00:00"
T3 = "2000-01-01 00:00:00"
LO = "1997-12-31 23:59:59"  # T0 minus the lookback


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def proj(spark: SparkSession, sf: str) -> DataFrame:
    """Orders as parents; the last shipment, where it is not before the order, is the change."""
    shipped = (table(spark, sf, "lineitem").groupBy("l_orderkey")
               .agg(F.max("l_shipdate").alias("shipped")))
    joined = table(spark, sf, "orders").join(
        shipped, F.col("o_orderkey") == F.col("l_orderkey"), "left")
    return joined.select(
        F.col("o_orderkey").alias("pid"), F.col("o_custkey").alias("cust"),
        F.col("o_orderpriority").alias("prio"), F.col("o_orderdate").alias("create_date"),
        F.when(F.col("shipped") >= F.col("o_orderdate"), F.col("shipped")).alias("mod_date"))


def team_object(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("object_id"), F.col("o_orderkey").alias("team_id"),
        F.when(F.col("o_orderstatus") != "P", 1000000).otherwise(1000001).alias("class_id"))


def team_member(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("team_id"), F.col("l_suppkey").alias("user_id"),
        F.when(F.col("l_returnflag") != "R", 1).otherwise(0).alias("current_record"),
        F.col("l_shipdate").alias("mod_date"))


def attr(spark: SparkSession, sf: str) -> DataFrame:
    kind = F.col("l_linenumber") % 3
    return table(spark, sf, "lineitem").select(
        F.col("l_orderkey").alias("pid"), F.col("l_linenumber").alias("param_id"),
        F.when(kind == 0, F.col("l_returnflag")).alias("string_value"),
        F.when(kind == 1, F.col("l_shipdate")).alias("date_value"),
        F.when(kind == 2, F.col("l_quantity").cast("bigint")).alias("number_value"))


def param(spark: SparkSession) -> DataFrame:
    return spark.range(1, 8).select(
        F.col("id").cast("int").alias("param_id"),
        F.concat(F.lit("Line_"), F.col("id").cast("string")).alias("param_name"))


def event_eav(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "events").select("user_id", "event_type", "value", "ts", "event_id")


# The same adapters in SQL.
PROJ_SQL = """proj AS (
  SELECT o_orderkey AS pid, o_custkey AS cust, o_orderpriority AS prio,
         o_orderdate AS create_date,
         CASE WHEN shipped >= o_orderdate THEN shipped END AS mod_date
  FROM orders LEFT JOIN (SELECT l_orderkey, max(l_shipdate) AS shipped FROM lineitem
                         GROUP BY l_orderkey) s ON l_orderkey = o_orderkey)"""
TEAM_OBJECT_SQL = """team_object AS (
  SELECT o_orderkey AS object_id, o_orderkey AS team_id,
         CASE WHEN o_orderstatus <> 'P' THEN 1000000 ELSE 1000001 END AS class_id
  FROM orders)"""
TEAM_MEMBER_SQL = """team_member AS (
  SELECT l_orderkey AS team_id, l_suppkey AS user_id,
         CASE WHEN l_returnflag <> 'R' THEN 1 ELSE 0 END AS current_record,
         l_shipdate AS mod_date
  FROM lineitem)"""
PM_MEMBER_SQL = """pm_member AS (
  SELECT object_id, string_agg(CAST(user_id AS VARCHAR), ',' ORDER BY user_id) AS user_ids
  FROM team_member m JOIN team_object o ON m.team_id = o.team_id
  WHERE class_id = 1000000 AND current_record = 1 GROUP BY object_id)"""
