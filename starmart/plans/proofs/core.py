"""Proofs of the single operators: means, dates, filters, casts, pivot, split, joins, order,
dedupe, counts, profiles and the quality report."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ... import tables as TB
from ...functions.dates import sas_date, sas_day_number, year_month
from ...functions.text import part, split_place
from ...operators import aggregate as AG
from ...operators.clean import dedupe, project, require
from ...operators.lookup import enrich, orphans, resolve
from ...operators.quality import Check, check_tables
from .. import pipeline as PL
from .registry import _CNT, _SUM_INT, _sql_mean_half_up, _t, query  # noqa: F401


# ===================================================================== A1 A2: decimal means

@query("mean_decimal", f"""
with g as (
  select cast(year(ts) as integer) as year, cast(month(ts) as integer) as month, event_type,
         {_SUM_INT.format(v='value')} as s, {_CNT.format(v='value')} as c
  from events group by all)
select year, month, event_type, {_sql_mean_half_up('s', 'c', 'decimal(6,2)')} as avg_value from g
""")
def mean_decimal(spark, sf):
    ev = _t(spark, sf, "events").select(F.col("ts").cast("string").alias("dt"), "event_type", "value")
    keyed = require(ev.withColumns(year_month("dt")), ["year", "month"])
    return AG.mean_by(keyed, ["year", "month", "event_type"], "value", out="decimal(6,2)",
                      alias="avg_value")


@query("mean_decimal_by_country", f"""
with g as (
  select n_name, {_SUM_INT.format(v='s_acctbal')} as s, {_CNT.format(v='s_acctbal')} as c
  from supplier join nation on s_nationkey = n_nationkey group by all)
select n_name, {_sql_mean_half_up('s', 'c', 'decimal(10,2)')} as avg_acctbal from g
""")
def mean_decimal_by_country(spark, sf):
    nation = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("s_nationkey"), "n_name")
    s = resolve(_t(spark, sf, "supplier"), nation, "s_nationkey")
    return AG.mean_by(s, ["n_name"], "s_acctbal", out="decimal(10,2)", alias="avg_acctbal")


# ===================================================================== E1 E2 E3: dates

_DATE_TEXT_SQL = ("case when o_orderstatus = 'P' then strftime(o_orderdate, '%d.%m.%Y') "
                  "else strftime(o_orderdate, '%Y-%m-%d') end")


@query("date_parts", f"""
select cast(year(try_cast({_DATE_TEXT_SQL} as date)) as integer) as year,
       cast(month(try_cast({_DATE_TEXT_SQL} as date)) as integer) as month,
       count(*) as n_orders
from orders group by all
""")
def date_parts(spark, sf):
    o = _t(spark, sf, "orders")
    text = F.when(F.col("o_orderstatus") == "P", F.date_format("o_orderdate", "dd.MM.yyyy")) \
            .otherwise(F.date_format("o_orderdate", "yyyy-MM-dd"))
    d = o.select(text.alias("dt")).withColumns(year_month("dt"))
    return AG.count_by(d, ["year", "month"], alias="n_orders")


@query("date_dim", """
select d as arrival_date, cast(day(d) as integer) as day, cast(week(d) as integer) as week,
       cast(month(d) as integer) as month, cast(year(d) as integer) as year,
       cast(quarter(d) as integer) as quarter
from (select distinct cast(o_orderdate as date) as d from orders)
""")
def date_dim(spark, sf):
    o = _t(spark, sf, "orders").select(F.col("o_orderdate").cast("date").alias("arrival_date"))
    return PL.date_table(o)


@query("sas_date", """
select o_orderkey,
       date '1960-01-01' + cast(floor(cast(date_diff('day', date '1960-01-01', cast(o_orderdate as date)) as double)
             + (o_totalprice - floor(o_totalprice))) as integer) as arrival_date,
       case when o_orderkey * 997 < 2936550 then date '1960-01-01' + cast(o_orderkey * 997 as integer) end as far_date,
       case when o_orderkey * 97 <= 715509 then date '1960-01-01' - cast(o_orderkey * 97 as integer) end as early_date
from orders
""")
def sas_date_query(spark, sf):
    """Day numbers of the orders, and multiples of the order key up to 9999-12-31 and down to
    0001-01-01; beyond these days: null."""
    o = _t(spark, sf, "orders")
    day_number = sas_day_number("o_orderdate").cast("double") \
        + (F.col("o_totalprice") - F.floor("o_totalprice"))
    return o.select("o_orderkey", sas_date(day_number).alias("arrival_date"),
                    sas_date(F.col("o_orderkey") * 997).alias("far_date"),
                    sas_date(F.col("o_orderkey") * -97).alias("early_date"))


# ===================================================================== F1-F8: filters

@query("filter_eq", "select event_id, user_id, value from events where event_type = 'purchase'")
def filter_eq(spark, sf):
    return (_t(spark, sf, "events").filter(F.col("event_type") == "purchase")
            .select("event_id", "user_id", "value"))


@query("filter_ne", "select event_id, event_type from events where event_type <> 'click'")
def filter_ne(spark, sf):
    return (_t(spark, sf, "events").filter(F.col("event_type") != "click")
            .select("event_id", "event_type"))


@query("filter_code", """
select l_orderkey, l_linenumber, l_quantity from lineitem where l_quantity = 2.0
""")
def filter_code(spark, sf):
    return (_t(spark, sf, "lineitem").filter(F.col("l_quantity") == F.lit(2.0))
            .select("l_orderkey", "l_linenumber", "l_quantity"))


def _docs_labels(spark, sf) -> DataFrame:
    docs = _t(spark, sf, "documents").select("doc_id", "lang", "source")
    return docs.join(_t(spark, sf, "labels"), "doc_id", "left")


@query("require_columns", """
select d.doc_id, d.lang, l.quality, l.toxic
from documents d left join labels l on d.doc_id = l.doc_id
where l.quality is not null and l.toxic is not null
""")
def require_columns(spark, sf):
    j = _docs_labels(spark, sf).select("doc_id", "lang", "quality", "toxic")
    return require(j, ["quality", "toxic"])


@query("require_all", """
select d.doc_id, d.lang, d.source, l.quality, l.toxic
from documents d left join labels l on d.doc_id = l.doc_id
where d.doc_id is not null and d.lang is not null and d.source is not null
  and l.quality is not null and l.toxic is not null
""")
def require_all(spark, sf):
    return require(_docs_labels(spark, sf))


# ===================================================================== P1-P10: projections

@query("typed_projection", """
select try_cast(o_orderkey as integer) as order_id, try_cast(o_custkey as integer) as customer_id,
       o_orderstatus as status, try_cast(o_totalprice as decimal(12,2)) as total_price,
       try_cast(trunc(o_totalprice) as integer) as total_whole,
       cast(o_orderdate as date) as order_date
from orders
""")
def typed_projection(spark, sf):
    from pyspark.sql import types as T
    schema = T.StructType([
        T.StructField("order_id", T.IntegerType()),
        T.StructField("customer_id", T.IntegerType()),
        T.StructField("status", T.StringType()),
        T.StructField("total_price", T.DecimalType(12, 2)),
        T.StructField("total_whole", T.IntegerType()),
        T.StructField("order_date", T.DateType()),
    ])
    return project(_t(spark, sf, "orders"), schema, {
        "order_id": "o_orderkey", "customer_id": "o_custkey", "status": "o_orderstatus",
        "total_price": "o_totalprice", "total_whole": "o_totalprice", "order_date": "o_orderdate",
    })


@query("cast_safe", """
select p_partkey,
       try_cast(string_split(p_brand, '#')[2] as integer) as brand_no,
       try_cast(p_name as integer) as name_no,
       try_cast(cast(p_size as varchar) as integer) as size_no,
       try_cast(cast(p_size as varchar) || 'x' as integer) as size_bad
from part
""")
def cast_safe(spark, sf):
    p = _t(spark, sf, "part")
    return p.select(
        "p_partkey",
        part("p_brand", "#", 1).try_cast("int").alias("brand_no"),
        F.col("p_name").try_cast("int").alias("name_no"),
        F.col("p_size").cast("string").try_cast("int").alias("size_no"),
        F.concat(F.col("p_size").cast("string"), F.lit("x")).try_cast("int").alias("size_bad"),
    )


_PRICE_TEXT_SQL = ("cast(cast(p_retailprice as decimal(12,2)) as varchar) "
                   "|| cast(p_size % 10 as varchar)")


@query("cast_decimal", f"""
select p_partkey, {_PRICE_TEXT_SQL} as price_text,
       try_cast({_PRICE_TEXT_SQL} as decimal(6,2)) as price_6_2,
       try_cast({_PRICE_TEXT_SQL} as decimal(4,1)) as price_4_1,
       try_cast({_PRICE_TEXT_SQL} as decimal(10,0)) as price_whole
from part
""")
def cast_decimal(spark, sf):
    p = _t(spark, sf, "part")
    text = F.concat(F.col("p_retailprice").cast("decimal(12,2)").cast("string"),
                    (F.col("p_size") % 10).cast("string"))
    return p.select("p_partkey", text.alias("price_text")).select(
        "p_partkey", "price_text",
        F.col("price_text").try_cast("decimal(6,2)").alias("price_6_2"),
        F.col("price_text").try_cast("decimal(4,1)").alias("price_4_1"),
        F.col("price_text").try_cast("decimal(10,0)").alias("price_whole"),
    )


# ===================================================================== A3: pivot

@query("pivot_first", """
select o_custkey,
       min(o_totalprice) filter (where o_orderstatus = 'F') as "F",
       min(o_totalprice) filter (where o_orderstatus = 'O') as "O",
       min(o_totalprice) filter (where o_orderstatus = 'P') as "P"
from orders group by o_custkey
""")
def pivot_first(spark, sf):
    return AG.pivot_first(_t(spark, sf, "orders"), ["o_custkey"], "o_orderstatus",
                          ["F", "O", "P"], "o_totalprice")


# ===================================================================== E4-E7: split

_PLACE_SQL = """case when p_size <= 10 then upper(p_name)
            when p_size <= 25 then upper(p_name) || ', ' || substring(p_type, 1, 2)
            when p_size <= 40 then upper(p_name) || ', ' || p_type
            else upper(p_name) || ', ' || p_brand || ', ' || substring(p_type, 1, 2) end"""


@query("split_place", f"""
with p as (select p_partkey, p_brand, {_PLACE_SQL} as label from part),
q as (select *, regexp_extract(label, ',([^,]*)$', 1) as last_piece from p)
select p_partkey, label,
       string_split(label, ',')[1] as ref_city,
       substring(replace(string_split(label, ',')[2], ' ', ''), 1, 2) as ref_state,
       case when contains(label, ',') then regexp_extract(label, '^(.*),[^,]*$', 1) end as strict_city,
       case when contains(label, ',')
             and regexp_extract(last_piece, '^\\s*([A-Z]{{2}})([^A-Za-z]|$)', 1) <> ''
            then regexp_extract(last_piece, '^\\s*([A-Z]{{2}})([^A-Za-z]|$)', 1) end as strict_state,
       string_split(p_brand, '#')[1] as brand_0,
       string_split(p_brand, '#')[2] as brand_1,
       string_split(p_brand, '#')[3] as brand_2
from q
""")
def split_place_query(spark, sf):
    p = _t(spark, sf, "part")
    size = F.col("p_size")
    name = F.upper("p_name")
    label = (F.when(size <= 10, name)
              .when(size <= 25, F.concat(name, F.lit(", "), F.substring("p_type", 1, 2)))
              .when(size <= 40, F.concat(name, F.lit(", "), F.col("p_type")))
              .otherwise(F.concat(name, F.lit(", "), F.col("p_brand"), F.lit(", "),
                                  F.substring("p_type", 1, 2))))
    p = p.select("p_partkey", "p_brand", label.alias("label"))
    ref = split_place("label", "reference")
    strict = split_place("label", "strict")
    return p.select(
        "p_partkey", "label",
        ref["city"].alias("ref_city"), ref["state_code"].alias("ref_state"),
        strict["city"].alias("strict_city"), strict["state_code"].alias("strict_state"),
        *[part("p_brand", "#", i).alias(f"brand_{i}") for i in range(3)],
    )


# ===================================================================== J1-J3: joins

@query("lookup_inner", """
select c_custkey, c_name, n_name, r_name
from customer join nation on c_nationkey = n_nationkey join region on n_regionkey = r_regionkey
""")
def lookup_inner(spark, sf):
    nation = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name",
                                             F.col("n_regionkey").alias("r_regionkey"))
    c = _t(spark, sf, "customer").select("c_custkey", "c_name", "c_nationkey")
    j = enrich(c, [(nation, "c_nationkey"),
                   (_t(spark, sf, "region"), "r_regionkey")], how="inner")
    return j.select("c_custkey", "c_name", "n_name", "r_name")


@query("star_enrich", """
select l_orderkey, l_linenumber, cast(o_orderdate as date) as order_date, c_name, n_name
from lineitem
left join orders on l_orderkey = o_orderkey
left join customer on o_custkey = c_custkey
left join nation on c_nationkey = n_nationkey
""")
def star_enrich(spark, sf):
    li = _t(spark, sf, "lineitem").select("l_orderkey", "l_linenumber")
    o = _t(spark, sf, "orders").select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey",
                                       F.col("o_orderdate").cast("date").alias("order_date"))
    c = _t(spark, sf, "customer").select(F.col("c_custkey").alias("o_custkey"), "c_name",
                                         "c_nationkey")
    n = _t(spark, sf, "nation").select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    # Orders are enriched first (orders-sized shuffle by customer key), so the much larger
    # line items are shuffled once, by order key.  Same result as the left-deep chain because
    # the customer join only references orders.
    oc = enrich(o, [(c, "o_custkey"), (n, "c_nationkey")])
    j = enrich(li, [(oc, "l_orderkey")])
    return j.select("l_orderkey", "l_linenumber", "order_date", "c_name", "n_name")


@query("orphan_keys", """
select doc_id, lang from documents d where not exists (select 1 from labels l where l.doc_id = d.doc_id)
""")
def orphan_keys(spark, sf):
    docs = _t(spark, sf, "documents").select("doc_id", "lang")
    return orphans(docs, _t(spark, sf, "labels"), "doc_id")


# ===================================================================== O1-O3: order, dedupe

@query("dedupe_by_key", """
select o_orderkey, o_custkey, o_orderstatus, o_totalprice, o_orderdate, o_orderpriority
from orders
qualify row_number() over (partition by o_custkey order by o_orderdate desc, o_orderkey) = 1
""")
def dedupe_by_key(spark, sf):
    return dedupe(_t(spark, sf, "orders"), ["o_custkey"],
                  order=[("o_orderdate", False), ("o_orderkey", True)])


@query("dedupe_mixed_order", """
select o_orderkey, o_custkey, o_orderpriority, o_orderdate
from orders
qualify row_number() over (partition by o_custkey
                           order by o_orderdate, o_orderpriority desc, o_orderkey desc) = 1
""")
def dedupe_mixed_order(spark, sf):
    """A text column and an integer ordered against the leading direction."""
    o = _t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderdate")
    return dedupe(o, ["o_custkey"], order=[("o_orderdate", True), ("o_orderpriority", False),
                                           ("o_orderkey", False)])


@query("distinct_keys", "select distinct o_orderstatus, o_orderpriority from orders")
def distinct_keys(spark, sf):
    o = _t(spark, sf, "orders").select("o_orderstatus", "o_orderpriority")
    return dedupe(o, ["o_orderstatus", "o_orderpriority"])


@query("top_k", """
select o_orderkey, o_custkey, o_totalprice from orders
order by o_totalprice desc, o_orderkey limit 10
""")
def top_k(spark, sf):
    return (_t(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
            .orderBy(F.desc("o_totalprice"), F.asc("o_orderkey")).limit(10))


# ===================================================================== A4-A8: counts, profiles

@query("distinct_count", """
select event_type, count(*) as n_events, count(distinct user_id) as n_users from events group by all
""")
def distinct_count(spark, sf):
    ev = _t(spark, sf, "events")
    return AG.distinct_count(ev, ["event_type"], "user_id", alias="n_users", rows="n_events")


@query("group_count", """
select l_returnflag, l_linestatus, count(*) as n from lineitem group by all
""")
def group_count(spark, sf):
    return AG.count_by(_t(spark, sf, "lineitem"), ["l_returnflag", "l_linestatus"])


_PROFILE_COLS = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]


def _profile_sql(quantiles: bool) -> str:
    parts = []
    for c in _PROFILE_COLS:
        x = f"(case when {c} = 0 then 0.0 else {c} end)"
        q = ""
        if quantiles:
            q = (f", quantile_disc({x}, 0.25) as p25, quantile_disc({x}, 0.5) as p50, "
                 f"quantile_disc({x}, 0.75) as p75")
        parts.append(
            f"select '{c}' as \"column\", count({x}) as count, round(avg({x}), 6) as mean, "
            f"round(stddev_samp({x}), 6) as stddev, min({x}) as min, max({x}) as max{q} "
            f"from lineitem")
    return "\nunion all\n".join(parts)


@query("profile_numeric", _profile_sql(False))
def profile_numeric(spark, sf):
    return AG.profile(_t(spark, sf, "lineitem"), _PROFILE_COLS, digits=6)


@query("profile_quartiles", _profile_sql(True))
def profile_quartiles(spark, sf):
    return AG.profile(_t(spark, sf, "lineitem"), _PROFILE_COLS, quantiles=[0.25, 0.5, 0.75],
                      digits=6, exact=True)


def _mixed_sql(table: str, cols: dict[str, bool]) -> str:
    """``cols``: name -> is a number."""
    parts = []
    for c, number in cols.items():
        x = f"(case when try_cast({c} as double) = 0 then 0.0 else try_cast({c} as double) end)"
        low, high = (f"min({x})", f"max({x})") if number else (f"min({c})", f"max({c})")
        if number:
            low, high = (f"cast(cast({v} as bigint) as varchar) || '.0'" for v in (low, high))
        parts.append(f"select '{c}' as \"column\", count({c}) as count, round(avg({x}), 6) as mean, "
                     f"round(stddev_samp({x}), 6) as stddev, {low} as min, {high} as max, "
                     f"quantile_disc({x}, 0.5) as p50 from {table}")
    return "\nunion all\n".join(parts)


@query("profile_mixed", _mixed_sql("events", {"user_id": True, "event_type": False, "props": False})
       + "\nunion all\n" + _mixed_sql("orders", {"o_custkey": True, "o_orderstatus": False,
                                                 "o_orderpriority": False})
       + "\nunion all\n" + _mixed_sql("(select c_custkey, substring(c_name, 10) as name_no, "
                                      "c_mktsegment from customer)",
                                      {"c_custkey": True, "name_no": False, "c_mktsegment": False}))
def profile_mixed(spark, sf):
    """``summary()`` of frames with text columns, one of them with digits in it (the customer's
    number cut from the name)."""
    c = _t(spark, sf, "customer").select("c_custkey", F.expr("substring(c_name, 10)").alias("name_no"),
                                         "c_mktsegment")
    frames = [(_t(spark, sf, "events"), ["user_id", "event_type", "props"]),
              (_t(spark, sf, "orders"), ["o_custkey", "o_orderstatus", "o_orderpriority"]),
              (c, ["c_custkey", "name_no", "c_mktsegment"])]
    one, two, three = (AG.profile(df, cols, quantiles=[0.5], digits=6, exact=True) for df, cols in frames)
    return one.unionByName(two).unionByName(three)


def _quality_sql() -> str:
    parts = []
    for name, key in TB.DRIVER_KEYS.items():
        any_null = " or ".join(f"{k} is null" for k in key)
        all_set = " and ".join(f"{k} is not null" for k in key)
        keys = ", ".join(key)
        source = {"orders": "(select count(distinct l_orderkey) from lineitem)"}.get(name, "cast(null as bigint)")
        wrong = {"labels": 2}.get(name, 0)
        parts.append(
            f"select '{name}' as \"table\", count(*) as rows, "
            f"count(*) filter (where {any_null}) as null_keys, "
            f"count(*) filter (where {all_set}) - (select count(*) from (select distinct {keys} "
            f"from {name} where {all_set})) as duplicate_keys, cast({wrong} as integer) as type_mismatches, "
            f"{source} as source_keys from {name}")
    body = "\nunion all\n".join(parts)
    return (f"select *, rows > 0 and null_keys = 0 and duplicate_keys = 0 and type_mismatches = 0 "
            f"and (source_keys is null or source_keys = rows) as ok from ({body})")


@query("quality_report", _quality_sql())
def quality_report(spark, sf):
    """Every test table by its key; orders also by completeness (the orders that line items name)
    and labels by a declaration that two of its columns break (a missing one, another type)."""
    declared = T.StructType([T.StructField("doc_id", T.LongType()), T.StructField("quality", T.StringType()),
                             T.StructField("toxic", T.IntegerType()), T.StructField("spam", T.IntegerType())])
    tables = {n: Check(_t(spark, sf, n), k) for n, k in TB.DRIVER_KEYS.items()}
    tables["orders"] = Check(_t(spark, sf, "orders"), ["o_orderkey"], source=_t(spark, sf, "lineitem")
                             .select(F.col("l_orderkey").alias("o_orderkey")))
    tables["labels"] = Check(_t(spark, sf, "labels"), ["doc_id"], declared)
    return check_tables(tables)
