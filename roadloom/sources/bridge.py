"""Scenario tables seen through the driver's tables (see FIXTURES.md section 3).

Scenarios are of one size and grow in number with the tables: USERS users and ORDERS orders each.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Tracks and map elements of a scenario, at most.
USERS, ORDERS = 20, 2000
#: Map element types by the order's priority, 1 to 5.
TYPES = (2, 1, 11, 21, 31)


def track_states(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per track and frame, from ``events``."""
    e = spark.read.parquet(f"{sf_dir}/events.parquet").select("user_id", "ts", "event_id", "event_type")
    t = (F.row_number().over(Window.partitionBy("user_id").orderBy("ts", "event_id")) - 1).cast("int")
    e = e.withColumn("t", t)
    seen = F.col("event_type") != "signup"
    return e.select(
        F.floor(F.col("user_id") / USERS).alias("scenario_id"), F.col("user_id").alias("track_id"), "t", F.col("event_type").alias("label"),
        (1 + F.col("user_id") % 3).cast("int").alias("type"), F.when(F.col("event_type") == "error", 0).otherwise(1).alias("valid"),
        ((15 * F.col("t") + F.col("event_id") % 7) / 10).alias("x"), ((35 * (F.col("user_id") % 20) + F.col("event_id") % 5) / 10).alias("y"), ((F.col("event_id") % 4) / 10).alias("z"),
        F.when(seen, (15 + F.col("event_id") % 3).cast("double")).alias("vx"), F.when(seen, ((F.col("event_id") % 3) / 2)).alias("vy"),
        ((F.col("event_id") % 5) / 10).alias("heading"), (4 + F.col("user_id") % 3).cast("double").alias("length"), F.lit(2.0).alias("width"),
        F.when(F.col("event_id") % 97 == 0, 0.0).otherwise(1.5).alias("height"),
    )


def vertices(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per map element and vertex, from ``lineitem`` and ``orders``."""
    keys = ["l_orderkey", "l_linenumber", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_shipdate"]
    line = spark.read.parquet(f"{sf_dir}/lineitem.parquet").select(*keys)
    pt = (F.row_number().over(Window.partitionBy("l_orderkey").orderBy(*keys[1:])) - 1).cast("int")
    k, slot = F.col("l_orderkey"), F.floor(F.col("l_orderkey") / 20)
    kind = F.array(*map(F.lit, TYPES))[F.substring("o_orderpriority", 1, 1).cast("int") - 1]
    kinds = spark.read.parquet(f"{sf_dir}/orders.parquet").select(F.col("o_orderkey").alias("element_id"), kind.alias("type"))
    v = line.withColumn("pt", pt).select(
        F.floor(k / ORDERS).alias("scenario_id"), k.alias("element_id"), "pt", ((100 * (slot % 100) + 40 * F.col("pt")) / 10).alias("x"),
        ((35 * (k % 20) + F.col("l_partkey") % 5) / 10).alias("y"), ((F.col("l_suppkey") % 3) / 10).alias("z"),
    )
    return v.join(kinds, "element_id").select("scenario_id", "element_id", "type", "pt", "x", "y", "z")


def elements(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per map element: its points, and lanes' links 40 and 48 ids on and back, in the same scenario."""
    points = F.array_sort(F.collect_list(F.struct("pt", "x", "y", "z")))
    e = vertices(spark, sf_dir).groupBy("scenario_id", "element_id", "type").agg(F.transform(points, lambda p: F.struct(p["x"], p["y"], p["z"])).alias("points"))
    k = F.col("element_id")
    return e.withColumns({"exit_lanes": F.array(k + 40, k + 48), "entry_lanes": F.array(k - 40, k - 48)})


STATES_SQL = """states as (
select user_id // 20 as scenario_id, user_id as track_id, t, event_type as label, cast(1 + user_id % 3 as integer) as type, case when event_type = 'error' then 0 else 1 end as valid,
  (15 * t + event_id % 7) / 10 as x, (35 * (user_id % 20) + event_id % 5) / 10 as y, (event_id % 4) / 10 as z,
  case when event_type <> 'signup' then cast(15 + event_id % 3 as double) end as vx, case when event_type <> 'signup' then (event_id % 3) / 2 end as vy,
  (event_id % 5) / 10 as heading, cast(4 + user_id % 3 as double) as length, 2.0::double as width, case when event_id % 97 = 0 then 0.0::double else 1.5::double end as height
from (select *, cast(row_number() over (partition by user_id order by ts, event_id) - 1 as integer) as t from events))"""

VERTICES_SQL = """vertices as (
select l_orderkey // 2000 as scenario_id, l_orderkey as element_id,
  case substr(o_orderpriority, 1, 1) when '1' then 2 when '2' then 1 when '3' then 11 when '4' then 21 else 31 end as type, pt,
  (100 * ((l_orderkey // 20) % 100) + 40 * pt) / 10 as x, (35 * (l_orderkey % 20) + l_partkey % 5) / 10 as y, (l_suppkey % 3) / 10 as z
from (select *, cast(row_number() over (partition by l_orderkey
        order by l_linenumber, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_shipdate) - 1 as integer) as pt from lineitem)
join orders on o_orderkey = l_orderkey)"""
