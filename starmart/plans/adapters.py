"""Render the driver's test tables into the raw shapes the pipeline reads.

The star-schema builds expect temperature text, demographics text, label files and arrivals
records.  These adapters derive such inputs from the test tables with plain Spark
expressions and joins, so every proof query does work that grows with the tables.  The
matching DuckDB expressions live next to the queries in :mod:`starmart.plans.proofs`.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.dates import sas_day_number
from ..sources import labels as LB


def temperature_raw(events: DataFrame, customer: DataFrame, nation: DataFrame) -> DataFrame:
    """Readings as text: day of the event, its value, the event type as the city and the
    nation of the user (via customer) as the country."""
    users = customer.select(F.col("c_custkey").alias("user_id"), F.col("c_nationkey"))
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name")
    e = events.join(users, "user_id").join(n, "c_nationkey")
    return e.select(
        F.date_format("ts", "yyyy-MM-dd").alias("dt"),
        F.col("value").cast("string").alias("AverageTemperature"),
        F.col("event_type").alias("City"),
        F.col("n_name").alias("Country"),
    )


#: order status -> race label used as the pivot value in the demographics proof (fixed)
STATUS_RACE = {"F": "Asian", "O": "White", "P": "Hispanic or Latino"}


def demographics_raw(customer: DataFrame, nation: DataFrame, region: DataFrame,
                     orders: DataFrame) -> DataFrame:
    """One text row per (customer, order status): the customer as a city of its nation (state
    code = the region's two-letter code, as in the rendered port labels), figures from the
    customer key, and the number of orders of that status as the race count.  Rows of status P
    carry a different median age, so those cities appear in two groups."""
    counts = (orders.groupBy(F.col("o_custkey").alias("c_custkey"), "o_orderstatus")
                    .agg(F.count(F.lit(1)).alias("cnt")))
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"), "n_name",
                      F.col("n_regionkey").alias("r_regionkey"))
    r = region.select("r_regionkey", F.upper(F.substring("r_name", 1, 2)).alias("r_code"))
    c = customer.join(n, "c_nationkey").join(r, "r_regionkey").join(counts, "c_custkey")
    race = F.lit(None).cast("string")
    for status, label in STATUS_RACE.items():
        race = F.when(F.col("o_orderstatus") == status, F.lit(label)).otherwise(race)
    k = F.col("c_custkey")
    age_whole = F.when(F.col("o_orderstatus") == "P", F.col("c_nationkey") + 30) \
                 .otherwise(F.col("c_nationkey") + 20)
    return c.select(
        F.col("c_name").alias("City"),
        F.col("n_name").alias("State"),
        F.concat(age_whole.cast("string"), F.lit("."),
                 F.lpad((k % 100).cast("string"), 2, "0")).alias("Median Age"),
        (k * 3 + 100).cast("string").alias("Male Population"),
        (k * 2 + 50).cast("string").alias("Female Population"),
        (k * 5 + 150).cast("string").alias("Total Population"),
        (F.col("c_nationkey") * 10).cast("string").alias("Number of Veterans"),
        (k % 97).cast("string").alias("Foreign-born"),
        F.concat((F.col("c_nationkey") % 4 + 1).cast("string"), F.lit("."),
                 F.lpad((k % 1000).cast("string"), 3, "0")).alias("Average Household Size"),
        F.col("r_code").alias("State Code"),
        race.alias("Race"),
        F.col("cnt").cast("string").alias("Count"),
    )


def port_labels(customer: DataFrame, nation: DataFrame, region: DataFrame) -> DataFrame:
    """Port code and place label per customer; the label shape depends on the segment:
    no comma, two commas, a region name (foreign-like), or a code with a suffix."""
    n = nation.select(F.col("n_nationkey").alias("c_nationkey"),
                      F.col("n_regionkey").alias("r_regionkey"))
    r = region.select("r_regionkey", "r_name")
    c = customer.join(n, "c_nationkey").join(r, "r_regionkey")
    code = F.upper(F.substring("r_name", 1, 2))
    seg = F.col("c_mktsegment")
    label = (F.when(seg == "BUILDING", F.col("c_name"))
              .when(seg == "AUTOMOBILE", F.concat_ws(", ", F.upper(seg), F.col("c_name"), code))
              .when(seg == "FURNITURE", F.concat_ws(", ", F.col("c_name"), F.col("r_name")))
              .otherwise(F.concat(F.col("c_name"), F.lit(", "), code, F.lit(" #"), seg)))
    return c.select(F.concat(F.lit("P"), F.col("c_custkey").cast("string")).alias("port_code"),
                    label.alias("port"))


def write_label_files(path: str, customer: DataFrame, nation: DataFrame, region: DataFrame,
                      orders: DataFrame) -> None:
    """Write label-file text derived from the tables: countries (nations), states (regions,
    two-letter codes), ports (customers) and travel modes (order priorities)."""
    LB.write_formats(nation, path, LB.COUNTRY_FORMAT, "n_nationkey", "n_name", quoted=False)
    states = region.select(F.upper(F.substring("r_name", 1, 2)).alias("code"), "r_name")
    LB.write_formats(states, path, LB.STATE_FORMAT, "code", "r_name")
    LB.write_formats(port_labels(customer, nation, region), path, LB.PORT_FORMAT,
                     "port_code", "port")
    modes = (orders.select("o_orderpriority").distinct()
                   .select(F.substring("o_orderpriority", 1, 1).alias("code"),
                           F.substring("o_orderpriority", 3, 100).alias("label")))
    LB.write_formats(modes, path, LB.MODE_FORMAT, "code", "label", quoted=False)


#: return flag -> visa category of the arrivals proof (fixed): N rows are the pleasure trips
FLAG_VISA = {"A": 1.0, "N": 2.0, "R": 3.0}


def arrivals_from_lineitem(lineitem: DataFrame) -> DataFrame:
    """Arrivals records (ARRIVALS shape, doubles as a SAS reader gives) from line items.

    The day number adds the discount as a fraction of a day, which must be floored away.
    """
    visa = _visa()
    return lineitem.select(
        (F.col("l_orderkey") * 8 + F.col("l_linenumber")).cast("double").alias("cicid"),
        F.year("l_shipdate").cast("double").alias("i94yr"),
        F.month("l_shipdate").cast("double").alias("i94mon"),
        F.col("l_suppkey").cast("double").alias("i94cit"),
        F.col("l_partkey").cast("double").alias("i94res"),
        F.concat("l_returnflag", "l_linestatus").alias("i94port"),
        (sas_day_number("l_shipdate").cast("double") + F.col("l_discount")).alias("arrdate"),
        F.col("l_linenumber").cast("double").alias("i94mode"),
        F.col("l_quantity").alias("i94bir"),
        visa.alias("i94visa"),
        F.col("l_linestatus").alias("gender"),
        F.concat(F.lit("C"), (F.col("l_suppkey") % 10).cast("string")).alias("airline"),
        F.concat(F.lit("B"), F.col("l_linenumber").cast("string")).alias("visatype"),
    )


def arrivals_with_ports(lineitem: DataFrame, orders: DataFrame, customer: DataFrame) -> DataFrame:
    """Arrivals records whose codes join the dimensions rendered by :func:`write_label_files`:
    the port is the ordering customer's port (``P<custkey>``), the residence country is the
    customer's nation, the birth country a nation from the supplier key.  Line numbers map to
    travel modes (1-2 air, 3-4 sea, 5-6 land, 7 not reported) and line status to gender."""
    # orders get their customer's nation first, so line items are shuffled once (by order key)
    c = customer.select(F.col("c_custkey").alias("o_custkey"), "c_nationkey")
    oc = orders.select(F.col("o_orderkey").alias("l_orderkey"), "o_custkey").join(c, "o_custkey")
    li = lineitem.join(oc, "l_orderkey")
    ln = F.col("l_linenumber")
    mode = (F.when(ln <= 2, 1.0).when(ln <= 4, 2.0).when(ln <= 6, 3.0).otherwise(9.0))
    return li.select(
        (F.col("l_orderkey") * 8 + ln).cast("double").alias("cicid"),
        F.year("l_shipdate").cast("double").alias("i94yr"),
        F.month("l_shipdate").cast("double").alias("i94mon"),
        (F.col("l_suppkey") % 25).cast("double").alias("i94cit"),
        F.col("c_nationkey").cast("double").alias("i94res"),
        F.concat(F.lit("P"), F.col("o_custkey").cast("string")).alias("i94port"),
        (sas_day_number("l_shipdate").cast("double") + F.col("l_discount")).alias("arrdate"),
        mode.alias("i94mode"),
        F.col("l_quantity").alias("i94bir"),
        _visa().alias("i94visa"),
        F.when(F.col("l_linestatus") == "F", F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.concat(F.lit("C"), (F.col("l_suppkey") % 10).cast("string")).alias("airline"),
        F.concat(F.lit("B"), ln.cast("string")).alias("visatype"),
    )


def _visa() -> F.Column:
    visa = F.lit(None).cast("double")
    for flag, code in FLAG_VISA.items():
        visa = F.when(F.col("l_returnflag") == flag, F.lit(code)).otherwise(visa)
    return visa
