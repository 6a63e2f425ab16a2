"""Proofs of the sources and sinks: CSV and Parquet round trips, typed scans, refreshes."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ...operators import rejects as RJ
from ...operators.clean import col
from ...session import scratch_path
from ...sources import labels as LB
from ...sources.arrivals import read_arrivals
from ...sources.delimited import read_delimited, read_lines, write_delimited
from ...sources.parquet import read_table, write_table
from ...streaming.refresh import refresh_from_landing
from .. import adapters as AD
from .registry import _money, _t, query  # noqa: F401


# ===================================================================== S2-S9: sources, sinks

def _orders_by_month_sql(where: str = "") -> str:
    return (f"select cast(year(o_orderdate) as integer) as year, "
            f"cast(month(o_orderdate) as integer) as month, count(*) as n, "
            f"cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(38,2)) as total "
            f"from orders {where} group by all")


def _orders_by_month(df: DataFrame) -> DataFrame:
    return df.groupBy("year", "month").agg(F.count(F.lit(1)).alias("n"),
                                           _money("o_totalprice").alias("total"))


def _with_month(orders: DataFrame) -> DataFrame:
    return orders.withColumns({"year": F.year("o_orderdate").cast("int"),
                               "month": F.month("o_orderdate").cast("int")})


@query("parquet_roundtrip", """
select l_returnflag, l_linestatus, count(*) as n, cast(sum(l_quantity) as bigint) as qty,
       cast(sum(cast(l_extendedprice as decimal(18,2))) as decimal(38,2)) as price
from lineitem group by all
""")
def parquet_roundtrip(spark, sf):
    path = scratch_path(spark, "parquet")
    write_table(_t(spark, sf, "lineitem"), path)
    back = read_table(spark, path)
    return back.groupBy("l_returnflag", "l_linestatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("l_quantity").cast("bigint").alias("qty"),
        _money("l_extendedprice").alias("price"))


@query("partitioned_roundtrip", _orders_by_month_sql())
def partitioned_roundtrip(spark, sf):
    path = scratch_path(spark, "partitioned")
    write_table(_with_month(_t(spark, sf, "orders")), path, partition_by=["year", "month"])
    return _orders_by_month(read_table(spark, path))


_ORDERS_TEXT = ["o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate",
                "o_orderpriority"]


@query("csv_roundtrip", """
select o_orderstatus, count(*) as n,
       cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(38,2)) as total,
       min(cast(o_orderdate as date)) as first_date, max(o_orderkey) as last_key
from orders group by all
""")
def csv_roundtrip(spark, sf):
    from pyspark.sql import types as T
    path = scratch_path(spark, "csv")
    write_delimited(_t(spark, sf, "orders").select(*_ORDERS_TEXT), path, sep=",")
    text = read_delimited(spark, path, T.StructType([T.StructField(c, T.StringType())
                                                     for c in _ORDERS_TEXT]), sep=",")
    return text.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"),
        _money("o_totalprice").alias("total"),
        F.min(F.col("o_orderdate").try_cast("date")).alias("first_date"),
        F.max(F.col("o_orderkey").try_cast("bigint")).alias("last_key"))


_CUSTOMER_TEXT = {"c_custkey": "Customer Key", "c_name": "Customer Name",
                  "c_nationkey": "Nation Key", "c_acctbal": "Account Balance",
                  "c_mktsegment": "Market Segment"}


@query("csv_semicolon_roundtrip", """
select c_mktsegment as market_segment, count(*) as n,
       cast(sum(cast(c_acctbal as decimal(18,2))) as decimal(38,2)) as balance,
       count(distinct c_nationkey) as nations
from customer group by all
""")
def csv_semicolon_roundtrip(spark, sf):
    from pyspark.sql import types as T
    path = scratch_path(spark, "csv-semicolon")
    cust = _t(spark, sf, "customer").select(*[F.col(k).alias(v) for k, v in _CUSTOMER_TEXT.items()])
    write_delimited(cust, path, sep=";")
    schema = T.StructType([T.StructField(v, T.StringType()) for v in _CUSTOMER_TEXT.values()])
    text = read_delimited(spark, path, schema, sep=";")
    return text.groupBy(col("Market Segment").alias("market_segment")).agg(
        F.count(F.lit(1)).alias("n"),
        _money("Account Balance").alias("balance"),
        F.count_distinct(col("Nation Key").try_cast("int")).alias("nations"))


@query("typed_scan", """
select case l_returnflag when 'A' then 1.0 when 'N' then 2.0 when 'R' then 3.0 end as i94visa,
       cast(l_linenumber as double) as i94mode, count(*) as n,
       cast(sum(l_quantity) as bigint) as age_sum
from lineitem group by all
""")
def typed_scan(spark, sf):
    path = scratch_path(spark, "arrivals")
    write_table(AD.arrivals_from_lineitem(_t(spark, sf, "lineitem")), path)
    a = read_arrivals(spark, path)
    return a.groupBy("i94visa", "i94mode").agg(F.count(F.lit(1)).alias("n"),
                                              F.sum("i94bir").cast("bigint").alias("age_sum"))


#: the month restated by the refresh proofs (fixed parameter of the proof)
REFRESH_YEAR, REFRESH_MONTH = 1998, 8


@query("incremental_overwrite", f"""
with t as (
  select * from orders
  where not (year(o_orderdate) = {REFRESH_YEAR} and month(o_orderdate) = {REFRESH_MONTH})
  union all
  select * from orders
  where year(o_orderdate) = {REFRESH_YEAR} and month(o_orderdate) = {REFRESH_MONTH}
    and o_orderstatus = 'F')
select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
       count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(38,2)) as total
from t group by all
""")
def incremental_overwrite(spark, sf):
    """Full load, then a restatement of one month (only its F orders) with dynamic overwrite:
    that month is replaced, every other month stays as loaded."""
    path = scratch_path(spark, "incremental")
    orders = _with_month(_t(spark, sf, "orders"))
    write_table(orders, path, partition_by=["year", "month"])
    month = orders.filter((F.col("year") == REFRESH_YEAR) & (F.col("month") == REFRESH_MONTH))
    write_table(month.filter(F.col("o_orderstatus") == "F"), path,
                partition_by=["year", "month"], dynamic=True)
    return _orders_by_month(read_table(spark, path))


_STREAM_SQL = f"""
with t as (
  select * from orders
  where not (year(o_orderdate) = {REFRESH_YEAR} and month(o_orderdate) = {REFRESH_MONTH})
  union all
  select * from orders
  where year(o_orderdate) = {REFRESH_YEAR} and month(o_orderdate) = {REFRESH_MONTH}
    and o_orderstatus = 'O')
select cast(year(o_orderdate) as integer) as year, cast(month(o_orderdate) as integer) as month,
       count(*) as n, cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(38,2)) as total
from t group by all
"""


@query("incremental_stream", _STREAM_SQL)
def incremental_stream(spark, sf):
    """Monthly drops land as Parquet; a Structured Streaming job (available-now trigger)
    folds them into the month-partitioned table with dynamic overwrite per micro-batch.  A second
    drop restates one month (only its O orders): a second run replaces that month only."""
    landing = scratch_path(spark, "landing")
    target = scratch_path(spark, "refreshed")
    checkpoint = scratch_path(spark, "refresh-ckpt")
    orders = _with_month(_t(spark, sf, "orders"))
    month = orders.filter((F.col("year") == REFRESH_YEAR) & (F.col("month") == REFRESH_MONTH)
                          & (F.col("o_orderstatus") == "O"))
    for drop in (orders, month):
        write_table(drop, landing, partition_by=["year", "month"], mode="append")
        refresh_from_landing(spark, landing, orders.schema, target, checkpoint, ["year", "month"])
    return _orders_by_month(read_table(spark, target))


@query("csv_mixed_headers", """
select o_orderstatus, count(*) as n,
       cast(sum(cast(o_totalprice as decimal(18,2))) as decimal(38,2)) as total,
       min(cast(o_orderdate as date)) as first_date, sum(o_custkey) as customers
from orders group by all
""")
def csv_mixed_headers(spark, sf):
    """Two extracts of the orders with their columns in another order and their names in another
    case, read by name and by declared types."""
    from pyspark.sql import types as T
    root = scratch_path(spark, "csv-mixed")
    orders = _t(spark, sf, "orders").select(*_ORDERS_TEXT)
    odd = F.col("o_orderkey") % 2 == 1
    write_delimited(orders.filter(~odd), f"{root}/a")
    turned = [F.col(c).alias(c.upper()) for c in reversed(_ORDERS_TEXT)]
    write_delimited(orders.filter(odd).select(*turned), f"{root}/b")
    schema = T.StructType([
        T.StructField("o_orderstatus", T.StringType()), T.StructField("o_custkey", T.LongType()),
        T.StructField("o_orderdate", T.TimestampType()), T.StructField("o_totalprice", T.DecimalType(18, 2))])
    rows = read_delimited(spark, [f"{root}/a", f"{root}/b"], schema)
    return rows.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("n"), F.sum("o_totalprice").cast("decimal(38,2)").alias("total"),
        F.min(F.to_date("o_orderdate")).alias("first_date"), F.sum("o_custkey").alias("customers"))


@query("arrivals_csv", """
select case l_returnflag when 'A' then 1.0 when 'N' then 2.0 when 'R' then 3.0 end as i94visa,
       l_returnflag || l_linestatus as i94port, count(*) as n, cast(sum(l_quantity) as bigint) as age_sum
from lineitem group by all
""")
def arrivals_csv(spark, sf):
    """The arrivals as a CSV extract with the columns in another order, read with declared types."""
    path = scratch_path(spark, "arrivals-csv")
    arrivals = AD.arrivals_from_lineitem(_t(spark, sf, "lineitem"))
    write_delimited(arrivals.select(*reversed(arrivals.columns)), path)
    return read_arrivals(spark, path, "csv").groupBy("i94visa", "i94port").agg(
        F.count(F.lit(1)).alias("n"), F.sum("i94bir").cast("bigint").alias("age_sum"))


@query("labels_many_pairs", """
select 'P' || cast(c_custkey as varchar) as code, replace(c_name, '#', '') || ' of ' || c_mktsegment as label
from customer
""")
def labels_many_pairs(spark, sf):
    """Label-file blocks of many pairs: one block per nation and market segment, quotes doubled,
    with a comment and a stray pair outside any block (quotes do not stay in labels)."""
    path = scratch_path(spark, "labels-many")
    esc = F.replace("label", F.lit("'"), F.lit("'" * 2))
    pairs = _t(spark, sf, "customer").select(
        "c_nationkey", "c_mktsegment", F.col("c_custkey").cast("string").alias("k"),
        F.concat(F.replace("c_name", F.lit("#"), F.lit("'")), F.lit(" of "), F.col("c_mktsegment")).alias("label"))
    lines = F.concat(F.lit("   'P"), F.col("k"), F.lit("'\t=  '"), esc, F.lit("'"))
    blocks = pairs.groupBy("c_nationkey", "c_mktsegment").agg(
        F.concat(F.lit("/* value $x 'a' = 'b'; */\r\n'Z'='z'\r\n  value $I94PRTL\r\n"),
                 F.concat_ws("\r\n", F.sort_array(F.collect_list(lines))), F.lit("\r\n;\r\n")).alias("value"))
    blocks.select("value").write.text(path)
    return LB.code_list(LB.read_formats(spark, path), LB.PORT_FORMAT)


@query("labels_split", """
select 'O' || cast(o_orderkey as varchar) as code,
       'C' || cast(o_custkey as varchar) || ' of ' || o_orderpriority as label from orders
""")
def labels_split(spark, sf):
    """Label files of one block per order; comments before, inside and behind the blocks hold ``;`` and
    whole blocks that do not count, so pieces are cut inside comments everywhere."""
    path = scratch_path(spark, "labels-split")
    k, who = F.col("o_orderkey").cast("string"), F.concat(F.lit("C"), F.col("o_custkey").cast("string"))
    text = F.concat(
        F.lit("/* "), who, F.lit("; value $i94prtl 'X"), k, F.lit("' = 'no'; */\r\n value $i94prtl /* from; "),
        F.coalesce("o_orderstatus", F.lit("")), F.lit(" */ 'O"), k, F.lit("'\t=\t'"), who, F.lit(" of "),
        "o_orderpriority", F.lit("' ; /*/ one; two */"))
    _t(spark, sf, "orders").select(text.alias("value")).write.text(path)
    return LB.code_list(LB.read_formats(spark, path), LB.PORT_FORMAT)


#: the temperature lines of the reject proof: which records are spoilt, and how (fixed parameters)
_SPOILT = {"dt": 19, "AverageTemperature": 13, "City": 17, "surplus": 23}


@query("reject_report", """
with e as (select event_id, value,
    event_id % 23 = 0 as malformed, event_id % 17 = 0 as no_city, event_id % 13 = 0 as no_number,
    event_id % 19 = 0 as no_date, abs(round(value * 1000, 0)) >= 99999.5 as too_large from events),
c as (select count(*) as read, count(*) filter (where malformed) as m,
    count(*) filter (where not malformed and no_city) as city,
    count(*) filter (where not malformed and no_date) as day,
    count(*) filter (where not malformed and (no_number or too_large)) as temp,
    count(*) filter (where malformed or no_city or no_date or no_number or too_large) as rejected from e)
select unnest(['read', 'kept', 'rejected', 'malformed row', 'dt: missing', 'dt: not date',
               'average_temperature: missing', 'average_temperature: not decimal(5,0)', 'city: missing',
               'city: not string']) as what,
       unnest([read, read - rejected, rejected, m, 0, day, 0, temp, city, 0]) as observed,
       unnest([read, read - rejected, rejected, m, 0, day, 0, temp, city, 0]) as written from c
""")
def reject_report(spark, sf):
    """Temperature lines rendered from the events, some spoilt: what the one pass observed, beside what
    the written tables hold."""
    e = _t(spark, sf, "events")
    spoilt = {k: F.col("event_id") % n == 0 for k, n in _SPOILT.items()}
    line = F.concat_ws(
        ",", F.when(spoilt["dt"], F.lit("31/31/2024")).otherwise(F.date_format("ts", "yyyy-MM-dd")),
        F.when(spoilt["AverageTemperature"], F.lit("n/a"))
        .otherwise(F.round(F.col("value") * 1000, 0).cast("decimal(20,1)").cast("string")),
        F.when(spoilt["City"], F.lit("")).otherwise(F.concat(F.lit("C"), F.col("user_id").cast("string"))),
        F.when(spoilt["surplus"], F.lit("one,more")).otherwise(F.lit("home")))
    path = scratch_path(spark, "spoilt-lines")
    e.select(line.alias("value")).write.text(path)
    raw = read_lines(spark, path, ["dt", "AverageTemperature", "City", "Country"])
    schema = T.StructType([T.StructField("dt", T.DateType()), T.StructField("average_temperature", T.DecimalType(5, 0)),
                           T.StructField("city", T.StringType())])
    reasons = RJ.reasons_of(schema, schema.names)
    out = scratch_path(spark, "judged-lines")
    counts = RJ.write_judged(RJ.judged(raw, schema, schema.names, {
        "average_temperature": "AverageTemperature", "city": "City"}, "_corrupt_record"), out, reasons)
    rejected = RJ.read_rejected(spark, out, raw.schema)
    kept_n = RJ.read_kept(spark, out, schema).agg(F.count(F.lit(1)).alias("n")).select(F.lit(RJ.KEPT).alias("what"), "n")
    rejected_n = rejected.agg(F.count(F.lit(1)).alias("n")).select(F.lit(RJ.REJECTED).alias("what"), "n")
    by_outcome = kept_n.unionByName(rejected_n)
    written = (by_outcome.unionByName(by_outcome.agg(F.sum("n").alias("n")).select(F.lit("read").alias("what"), "n"))
               .unionByName(rejected.select(F.explode("reasons").alias("what")).groupBy("what")
                            .agg(F.count(F.lit(1)).alias("n"))))
    observed = spark.createDataFrame(list(counts.items()), "what string, observed long")
    return (observed.join(written, "what", "left")
            .select("what", "observed", F.coalesce("n", F.lit(0).cast("long")).alias("written")))
