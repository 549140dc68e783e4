"""Scalar rules, newest-per-key, averages and rankings."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from assayflow.functions import as_timestamp, elapsed_days, greatest_strict, month_start, safe_ratio, trim_whitespace
from assayflow.operators.columns import project
from assayflow.operators.dedup import dedup
from assayflow.operators.joins import pairs_by_type
from assayflow.plans.dimensions import stock_state
from assayflow.plans.marts import average_of
from assayflow.queries.base import query, table
from assayflow.queries.lab import AS_OF, lab_sql, raw_samples, raw_stocks
from assayflow.plans.staging import stage_samples, stage_stocks


@query("""
select regexp_replace(chr(9) || ' ' || o_orderpriority || ' ' || chr(10), '^\\s+|\\s+$', '', 'g') as priority,
    cast(nullif(case when o_orderstatus = 'O' then '' else cast(o_orderdate as varchar) end, '') as timestamp)
        as closed_at, o_orderkey
from orders""")
def clean_strings(spark: SparkSession, sf_dir: str) -> DataFrame:
    padded = F.concat(F.lit("\t "), F.col("o_orderpriority"), F.lit(" \n"))
    closed = F.when(F.col("o_orderstatus") == "O", "").otherwise(F.col("o_orderdate").cast("string"))
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", trim_whitespace(padded).alias("priority"), as_timestamp(closed).alias("closed_at")
    )


@query("""
select user_id, date_sub('day', min(ts), max(ts)) as days_active from events group by user_id""", name="elapsed_days")
def elapsed_days_per_user(spark: SparkSession, sf_dir: str) -> DataFrame:
    span = table(spark, sf_dir, "events").groupBy("user_id").agg(F.min("ts").alias("a"), F.max("ts").alias("b"))
    return span.select("user_id", elapsed_days(F.col("a"), F.col("b")).alias("days_active"))


@query(lab_sql(f"""
select stock_id, expiry_date, quantity,
    case when expiry_date < date '{AS_OF}' then true else false end as is_expired,
    case when quantity <= 0 then true else false end as is_depleted,
    expiry_date - date '{AS_OF}' as days_until_expiry
from stg_stocks"""))
def expiry_flags(spark: SparkSession, sf_dir: str) -> DataFrame:
    state = stock_state(stage_stocks(raw_stocks(spark, sf_dir)), AS_OF)
    return state.select("stock_id", "expiry_date", "quantity", "is_expired", "is_depleted", "days_until_expiry")


@query("""
select cast(date_trunc('month', o_orderdate) as date) as run_month, count(*) as n_orders
from orders group by 1""", name="month_start")
def month_start_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    day = F.col("o_orderdate").cast("date")
    orders = table(spark, sf_dir, "orders").select(month_start(day).alias("run_month"))
    return orders.groupBy("run_month").agg(F.count(F.lit(1)).alias("n_orders"))


@query("""
select o_orderkey, case when shipped is not null
    then greatest(cast(o_orderdate as date), shipped) end as newest_day
from orders left join (
    select l_orderkey, max(cast(l_shipdate as date)) as shipped from lineitem group by 1
) on o_orderkey = l_orderkey""", name="greatest_strict")
def greatest_strict_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").groupBy(F.col("l_orderkey").alias("o_orderkey"))
    shipped = lines.agg(F.max(F.col("l_shipdate").cast("date")).alias("shipped"))
    joined = table(spark, sf_dir, "orders").join(shipped, "o_orderkey", "left")
    newest = greatest_strict(F.col("o_orderdate").cast("date"), F.col("shipped"))
    return joined.select("o_orderkey", newest.alias("newest_day"))


LATEST_EVENTS = """
select event_id, ts, user_id, event_type, value, props from events
qualify row_number() over (partition by user_id order by ts desc nulls last, event_id desc) = 1"""


def latest_first():
    return [F.col("ts").desc_nulls_last(), F.col("event_id").desc()]


@query(LATEST_EVENTS)
def dedup_latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedup(table(spark, sf_dir, "events"), ["user_id"], latest_first(), tie_break=[])


@query("""
select cast(o_orderkey as varchar) as order_id, o_custkey as customer_id, o_orderstatus as status,
    o_totalprice as total_price, cast(o_orderdate as date) as run_date, o_orderpriority
from orders""")
def scan_typed(spark: SparkSession, sf_dir: str) -> DataFrame:
    specs = (
        "o_orderkey string order_id",
        "o_custkey bigint customer_id",
        "o_orderstatus as_is status",
        "o_totalprice double total_price",
        "o_orderdate day run_date",
        "o_orderpriority trim",
    )
    return project(table(spark, sf_dir, "orders"), specs)


@query("""
select l_partkey, avg(case when l_linenumber in (1, 7) then l_quantity end) as avg_binding_affinity,
    avg(case when l_linenumber in (2, 6) then l_quantity end) as avg_cytotoxicity,
    avg(case when l_linenumber in (3, 4) then l_quantity end) as avg_cytokine,
    avg(case when l_linenumber = 5 then l_quantity end) as avg_inhibition
from lineitem group by l_partkey""")
def endpoint_pivot_avg(spark: SparkSession, sf_dir: str) -> DataFrame:
    values = table(spark, sf_dir, "lineitem").select(
        "l_partkey", F.col("l_linenumber").cast("string").alias("endpoint_name"), F.col("l_quantity").alias("endpoint_value")
    )
    return values.groupBy("l_partkey").agg(
        average_of(("1", "7")).alias("avg_binding_affinity"),
        average_of(("2", "6")).alias("avg_cytotoxicity"),
        average_of(("3", "4")).alias("avg_cytokine"),
        average_of(("5",)).alias("avg_inhibition"),
    )


@query("""
select c_custkey, count(o_orderkey) as n_orders,
    cast(count_if(o_orderstatus = 'F') as double) / nullif(count(o_orderkey), 0) as closed_rate
from customer left join orders on c_custkey = o_custkey group by c_custkey""")
def qc_pass_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select("c_custkey")
    orders = table(spark, sf_dir, "orders").groupBy(F.col("o_custkey").alias("c_custkey"))
    counts = orders.agg(F.count("o_orderkey").alias("n"), F.count_if(F.col("o_orderstatus") == "F").alias("closed"))
    joined = customers.join(counts, "c_custkey", "left")
    n = F.coalesce("n", F.lit(0))
    return joined.select("c_custkey", n.alias("n_orders"), safe_ratio(F.col("closed"), n).alias("closed_rate"))


@query("""
select p_type, l_partkey, avg(l_quantity) as avg_score
from lineitem join part on l_partkey = p_partkey
group by p_type, l_partkey""")
def rank_by_average(spark: SparkSession, sf_dir: str) -> DataFrame:
    per_part = table(spark, sf_dir, "lineitem").groupBy("l_partkey").agg(F.avg("l_quantity").alias("avg_score"))
    parts = table(spark, sf_dir, "part").select("p_type", F.col("p_partkey").alias("l_partkey"))
    return per_part.join(parts, "l_partkey").orderBy(F.col("avg_score").desc_nulls_last(), "l_partkey")


@query("""
select o_orderkey, o_custkey, o_orderdate from orders order by o_orderdate desc nulls last, o_orderkey limit 10""")
def preview_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return orders.orderBy(F.col("o_orderdate").desc_nulls_last(), "o_orderkey").limit(10)


@query(lab_sql("""
select sample_type, count(*) as n_pairs, count(distinct sample_id) as n_samples
from stg_stocks join stg_samples using (sample_id) group by sample_type"""))
def stock_pairs_by_type(spark: SparkSession, sf_dir: str) -> DataFrame:
    stocks, samples = stage_stocks(raw_stocks(spark, sf_dir)), stage_samples(raw_samples(spark, sf_dir))
    return pairs_by_type(stocks, samples, "sample_id", "sample_type")
