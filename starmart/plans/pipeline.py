"""The four table builds of the star schema and the job that runs them all.

Every build is a pure ``DataFrame -> DataFrame`` function over inputs in their raw shape
(column names as the sources spell them), so the same code runs on a one-row fixture, on the
driver's test tables and on the full data.  ``build_all`` reads, builds and writes.
"""

from __future__ import annotations

import uuid
from dataclasses import dataclass

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .. import tables as TB
from ..functions.dates import calendar_parts, sas_date, year_month
from ..functions.text import drop_blanks, split_place
from ..operators.aggregate import pivot_first
from ..operators.clean import col, dedupe, project, require
from ..operators.lookup import resolve
from ..operators.quality import Check, check_tables, orphan_report, require_ok
from ..session import scratch_path
from ..sources import labels as LB
from ..sources.arrivals import read_arrivals
from ..sources.delimited import read_delimited
from ..sources.parquet import exists, publish, recover, remove, write_table
from ..sources.versions import Version, Versions

HOME_COUNTRY = "United States"
PLEASURE_VISA = 2.0


def _with_type(schema: T.StructType, name: str, dtype: str | T.DataType) -> T.StructType:
    dt = T._parse_datatype_string(dtype) if isinstance(dtype, str) else dtype
    return T.StructType([T.StructField(f.name, dt if f.name == name else f.dataType, True,
                                       f.metadata) for f in schema.fields])


# ------------------------------------------------------------------ C1 temperatures

def clean_temperatures(raw: DataFrame) -> DataFrame:
    """Readings with a date, a value, a city and a country, and a parseable date (``year`` and
    ``month`` added).  Idempotent, so a cleaned (and persisted) frame can be passed on."""
    t = require(raw, ["dt", "AverageTemperature", "City", "Country"])
    if "year" not in t.columns or "month" not in t.columns:
        t = t.withColumns(year_month("dt"))
    return require(t, ["year", "month"])


def temperature_sums(raw: DataFrame, scale: int = 0) -> DataFrame:
    """Sum and count of the readings, each rounded HALF_UP to ``scale``, per (year, month, city,
    country): the small result that both temperature tables are made of."""
    t = clean_temperatures(raw)
    reading = col("AverageTemperature").try_cast(f"decimal(10,{scale})")
    return t.groupBy("year", "month", col("City").alias("city"), col("Country").alias("country")).agg(
        F.sum(reading).alias("total"), F.count(reading).alias("readings"))


def temperature_means(sums: DataFrame, home: str = HOME_COUNTRY, out: str = "decimal(4,2)"
                      ) -> tuple[DataFrame, DataFrame]:
    """The city table of the ``home`` country and the table of the other countries.

    The mean is the quotient of exact sums, rounded HALF_UP to four digits and then to ``out``; a
    mean that does not fit becomes null.
    """
    def means(rows: DataFrame, place: str, schema: T.StructType) -> DataFrame:
        mean = (F.sum("total").cast("decimal(20,0)") if sums.schema["total"].dataType.scale == 0
                else F.sum("total")) / F.sum("readings").cast("decimal(12,0)")
        return project(rows.groupBy("year", "month", place).agg(
            F.when(F.sum("readings") > 0, mean).try_cast("decimal(14,4)").try_cast(out)
            .alias("average_temperature")), _with_type(schema, "average_temperature", out))

    at_home = F.col("country") == F.lit(home)
    return (means(sums.filter(at_home), "city", TB.DIM_TEMPERATURE_CITY),
            means(sums.filter(~at_home), "country", TB.DIM_TEMPERATURE_COUNTRY))


def temperature_tables(raw: DataFrame, home: str = HOME_COUNTRY, scale: int = 0,
                       out: str = "decimal(4,2)") -> tuple[DataFrame, DataFrame]:
    """Monthly mean temperature per city of the ``home`` country and per other country.

    Readings are rounded to whole degrees (``scale=0``) before the mean, the mean is narrowed
    to ``out``; both steps round HALF_UP.  Rows without a date, reading, city or country and
    rows whose date text is malformed are dropped before grouping.
    """
    return temperature_means(temperature_sums(raw, scale), home, out)


# ------------------------------------------------------------------ C2 demographics

# fixed values: the names of the sources' columns and of the output contract
DEMOGRAPHIC_KEYS = ["State", "City", "Median Age", "Male Population", "Female Population",
                    "Total Population", "Number of Veterans", "Foreign-born",
                    "Average Household Size", "State Code"]

DEMOGRAPHIC_MAPPING = {
    "state": "State",
    "state_code": "State Code",
    "city": "City",
    "median_age": "Median Age",
    "male_population": "Male Population",
    "female_population": "Female Population",
    "total_population": "Total Population",
    "number_of_veterans": "Number of Veterans",
    "number_of_foregn_born": "Foreign-born",
    "avarage_household_size": "Average Household Size",
    "american_indian_alaska_native": TB.RACES[0],
    "asian": TB.RACES[1],
    "black_or_africanamerican": TB.RACES[2],
    "hispanic_or_latino": TB.RACES[3],
    "white": TB.RACES[4],
}


def demographic_table(raw: DataFrame, races: list[str] | None = None) -> DataFrame:
    """One row per (state, city) with population figures and one count column per race.

    Rows with any null are dropped first.  The race pivot lists its values (no discovery job)
    and takes the ``min`` count as int.  A city that appears with two different descriptive
    rows keeps the first in the order of all columns (deterministic).
    """
    races = races or TB.RACES
    d = require(raw)
    wide = pivot_first(d, DEMOGRAPHIC_KEYS, "Race", races, "Count", cast="int")
    typed = project(wide, TB.DIM_DEMOGRAPHICS, DEMOGRAPHIC_MAPPING)
    return dedupe(require(typed, ["state", "city"]), ["state", "city"])


# ------------------------------------------------------------------ C3 code tables

def code_tables(formats: DataFrame, place_mode: str = "reference") -> tuple[DataFrame, DataFrame, DataFrame]:
    """Country, port and travel-mode dimensions from parsed label-file pairs.

    Ports get ``city`` and ``state_code`` from their label (:func:`split_place`) and keep only
    labels whose state code is a listed state (inner join).
    """
    country = LB.code_list(formats, LB.COUNTRY_FORMAT, "country_code", "country")
    country = project(country.withColumn("country_code", drop_blanks("country_code")),
                      TB.DIM_COUNTRY)
    country = dedupe(require(country, ["country_code"]), ["country_code"])

    states = LB.code_list(formats, LB.STATE_FORMAT, "state_code", "state")
    ports = LB.code_list(formats, LB.PORT_FORMAT, "port_code", "port")
    ports = ports.withColumns(split_place("port", place_mode))
    port = resolve(ports, states, "state_code", how="inner")
    port = project(require(port, ["port_code"]), TB.DIM_PORT)
    port = dedupe(port, ["port_code"])

    mode = LB.code_list(formats, LB.MODE_FORMAT, "travel_mode_code", "travel_mode")
    mode = project(mode.withColumn("travel_mode_code", drop_blanks("travel_mode_code")),
                   TB.DIM_TRAVEL_MODE)
    mode = dedupe(require(mode, ["travel_mode_code"]), ["travel_mode_code"])
    return country, port, mode


# ------------------------------------------------------------------ C4 arrivals

# fixed values: the names of the sources' columns and of the output contract
FACT_MAPPING = {
    "cicid": "cicid",
    "arrival_year": "i94yr",
    "arrival_month": "i94mon",
    "arrival_date": "arrival_date",
    "arrival_port_code": "i94port",
    "visitor_birth_country": "i94cit",
    "visitor_residence_country": "i94res",
    "visitor_age": "i94bir",
    "visitor_gender": "gender",
    "travel_mode_code": "i94mode",
    "travel_airline": "airline",
    "travel_visa_type": "visatype",
}


def pleasure_arrivals(arrivals: DataFrame, visa: float = PLEASURE_VISA) -> DataFrame:
    """Arrivals of one visa category with the five required fields and an ``arrival_date``."""
    a = arrivals.filter(col("i94visa") == F.lit(visa))
    a = require(a, ["cicid", "i94res", "i94port", "arrdate", "i94mode"])
    return a.withColumn("arrival_date", sas_date("arrdate"))


def date_table(arrivals: DataFrame) -> DataFrame:
    """Date dimension: distinct arrival days with calendar parts (ISO week).

    Only the date is shuffled (``distinct`` combines map-side); the parts are computed after.
    """
    days = arrivals.select("arrival_date").filter(F.col("arrival_date").isNotNull()).distinct()
    return days.select("arrival_date", *[c.alias(n) for n, c in
                                         calendar_parts("arrival_date").items()])


def fact_table(arrivals: DataFrame) -> DataFrame:
    """Fact table: one row per ``cicid`` with typed, renamed columns.

    One scan and one shuffle by record id, whatever the share of repeated ids.
    """
    fact = project(arrivals.filter(F.col("arrival_date").isNotNull()), TB.FACT_ARRIVALS, FACT_MAPPING)
    return dedupe(require(fact, ["cicid"]), ["cicid"])


def arrival_tables(arrivals: DataFrame, visa: float = PLEASURE_VISA
                   ) -> tuple[DataFrame, DataFrame]:
    a = pleasure_arrivals(arrivals, visa)
    return date_table(a), fact_table(a)


# ------------------------------------------------------------------ C5 all

@dataclass
class Inputs:
    arrivals: str
    temperatures: str
    demographics: str
    labels: str
    arrivals_format: str = "parquet"


def build_star(spark: SparkSession, inputs: Inputs, home: str = HOME_COUNTRY,
               place_mode: str = "reference", sums: DataFrame | None = None
               ) -> dict[str, DataFrame]:
    """All eight tables as DataFrames (lazy), keyed by output table name.

    ``sums`` may hold stored :func:`temperature_sums` for both temperature tables.
    """
    arrivals = pleasure_arrivals(read_arrivals(spark, inputs.arrivals, inputs.arrivals_format))
    if sums is None:
        sums = temperature_sums(read_delimited(spark, inputs.temperatures, TB.TEMPERATURE_RAW, sep=","))
    demo = read_delimited(spark, inputs.demographics, TB.DEMOGRAPHICS_RAW, sep=";")
    formats = LB.read_formats(spark, inputs.labels)
    city, country = temperature_means(sums, home=home)
    c_dim, p_dim, m_dim = code_tables(formats, place_mode)
    return {
        FACT: fact_table(arrivals),
        DATES: date_table(arrivals),
        "dim_temperatures_us_cities_table": city,
        "dim_temperatures_countries_table": country,
        "dim_cities_demographic_table": demographic_table(demo),
        "dim_i94_country_table": c_dim,
        "dim_i94_port_table": p_dim,
        "dim_i94_travel_mode_table": m_dim,
    }


FACT, DATES = "fact_i94_us_visitor_arrivals_table", "dim_date_table"


def star_checks(spark: SparkSession, star: dict[str, DataFrame], inputs: Inputs | None = None
                ) -> dict[str, Check]:
    """The checks of the eight tables: keys and declared types; with the inputs also completeness
    of the fact (every record id of the arrivals kept) and of the dates (every arrival day)."""
    source = {}
    if inputs is not None:
        arrivals = pleasure_arrivals(read_arrivals(spark, inputs.arrivals, inputs.arrivals_format))
        arrivals = arrivals.filter(F.col("arrival_date").isNotNull())
        source = {FACT: arrivals.select(col("cicid").try_cast("bigint").alias("cicid")),
                  DATES: arrivals.select("arrival_date")}
    return {n: Check(df, TB.STAR[n][1], TB.STAR[n][0], source.get(n)) for n, df in star.items()}


def build_all(spark: SparkSession, inputs: Inputs, out: str, home: str = HOME_COUNTRY,
              place_mode: str = "reference", dynamic: bool = False, report: list | None = None,
              strict: bool = True) -> dict[str, str]:
    """Build the star schema under ``out``; returns table name -> path.

    The tables are first written to a staging folder and checked there (rows, keys, types,
    completeness; the rows of the report are appended to ``report``): a failed check raises and
    leaves the old tables as they are (``strict=False`` only reports).  Then each table takes the old
    one's place by a rename, one after the other; :func:`build_version` publishes all of them at once.

    ``dynamic=True`` (monthly refresh) replaces only the months present in this run.  The fact is
    kept by the recorded month, days by their own; so the date dimension is never replaced but gets
    the days it does not have yet, else a late arrival of a neighbouring month would drop the days
    of that month's other arrivals.

    The temperature text feeds two tables: it is parsed once into small sums.  Arrivals also feed
    two tables but are scanned for each: the date table reads the day number and the filter columns
    only, which costs less than storing every column.
    """
    out = out.rstrip("/")
    sums_path = scratch_path(spark, "temperature-sums")
    raw = read_delimited(spark, inputs.temperatures, TB.TEMPERATURE_RAW, sep=",")
    temperature_sums(raw).write.parquet(sums_path)
    star = build_star(spark, inputs, home, place_mode, spark.read.parquet(sums_path))
    staging = f"{out}/_staging-{uuid.uuid4().hex[:12]}"
    paths = {name: f"{out}/{name}.parquet" for name in star}
    staged = {name: f"{staging}/{name}.parquet" for name in star}
    for name, df in star.items():
        write_table(df, staged[name], partition_by=TB.STAR[name][2])
    new = read_star(spark, staged)
    # checked with the columns and types that the files have
    checked = check_tables(star_checks(spark, as_written(spark, staged, new), inputs))
    rows = require_ok(checked) if strict else checked.collect()
    if report is not None:
        report.extend(rows)
    for name, path in paths.items():
        parts = TB.STAR[name][2]
        recover(spark, path)
        if not (dynamic and parts and exists(spark, path)):
            publish(spark, staged[name], path)
        elif name == DATES:
            known = read_star(spark, {name: path})[name].select("arrival_date")
            write_table(new[name].join(known, "arrival_date", "left_anti"), path, parts, mode="append")
        else:
            write_table(new[name], path, partition_by=parts, dynamic=True)
    remove(spark, staging)
    return paths


def build_version(spark: SparkSession, inputs: Inputs, base: str, home: str = HOME_COUNTRY,
                  place_mode: str = "reference", dynamic: bool = False, report: list | None = None,
                  strict: bool = True) -> Version:
    """Build the star as the next version under ``base``: all eight tables appear at once, readers of the
    old version keep it, and a job that dies or fails a check publishes nothing.

    ``dynamic=True`` (monthly refresh) replaces the months met in this run - the others are shared with
    the old version, neither read nor copied - and adds the days that the date dimension lacks.
    """
    versions = Versions(spark, base)
    sums_path = scratch_path(spark, "temperature-sums")
    temperature_sums(read_delimited(spark, inputs.temperatures, TB.TEMPERATURE_RAW, sep=",")).write.parquet(sums_path)
    star = build_star(spark, inputs, home, place_mode, spark.read.parquet(sums_path))
    change = versions.change()
    staged = {name: f"{versions.base}/{change.write(name, df, TB.STAR[name][2])}" for name, df in star.items()}
    new = read_star(spark, staged)
    checked = check_tables(star_checks(spark, as_written(spark, staged, new), inputs))
    rows = require_ok(checked) if strict else checked.collect()
    if report is not None:
        report.extend(rows)
    for name, path in staged.items():
        parts, root = TB.STAR[name][2], path[len(versions.base) + 1:]
        if not (dynamic and parts and name in change.tables):
            change.use(name, root, parts)
        elif name == DATES:
            known = change.read(name, TB.STAR[name][0]).select("arrival_date")
            change.append(name, new[name].join(known, "arrival_date", "left_anti"), parts)
        else:
            change.use(name, root, parts, keep_others=True)
    return change.commit()


def read_version(version: Version) -> dict[str, DataFrame]:
    """The eight tables of a published version with their declared schemas."""
    return {name: version.read(name, TB.STAR[name][0]) for name in TB.STAR if name in version.tables}


def read_star(spark: SparkSession, paths: dict[str, str]) -> dict[str, DataFrame]:
    """Read written tables back with their declared schemas (partition columns last), so an
    empty table still has its columns."""
    out = {}
    for name, p in paths.items():
        schema, _, parts = TB.STAR[name]
        fields = [f for f in schema.fields if f.name not in parts] + \
                 [schema[c] for c in parts]
        out[name] = spark.read.schema(T.StructType(fields)).parquet(p)
    return out


def as_written(spark: SparkSession, paths: dict[str, str], declared: dict[str, DataFrame]
               ) -> dict[str, DataFrame]:
    """The tables with the schema of their files; a table without any file as declared."""
    out = {}
    for name, path in paths.items():
        try:
            out[name] = spark.read.parquet(path)
        except AnalysisException:
            out[name] = declared[name]
    return out


def star_integrity(star: dict[str, DataFrame]) -> DataFrame:
    """Orphan keys of the fact table against its dimensions (port, countries, travel mode, date)."""
    fact = star[FACT]
    country = star["dim_i94_country_table"]
    return orphan_report(fact, [
        ("arrival_port_code", "dim_i94_port_table", star["dim_i94_port_table"], "port_code"),
        ("visitor_residence_country", "dim_i94_country_table", country, "country_code"),
        ("visitor_birth_country", "dim_i94_country_table", country, "country_code"),
        ("travel_mode_code", "dim_i94_travel_mode_table", star["dim_i94_travel_mode_table"],
         "travel_mode_code"),
        ("arrival_date", "dim_date_table", star["dim_date_table"], "arrival_date"),
    ])
