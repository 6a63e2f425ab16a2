"""Declared schemas: the raw inputs and the eight output tables of the star schema.

Nothing is ever inferred.  Each output field carries a ``comment`` (the data dictionary).
Column names, including the two historical misspellings ``number_of_foregn_born`` and
``avarage_household_size``, are part of the output contract and must not be corrected.
"""

from __future__ import annotations

from pyspark.sql import types as T


def _f(name: str, dtype: T.DataType, comment: str = "") -> T.StructField:
    return T.StructField(name, dtype, True, {"comment": comment} if comment else {})


def _strings(*names: str) -> T.StructType:
    return T.StructType([_f(n, T.StringType()) for n in names])


# ---------------------------------------------------------------- raw inputs (all text)

#: city temperature CSV (comma, header); only these columns are used
TEMPERATURE_RAW = _strings("dt", "AverageTemperature", "City", "Country")

#: city demographics CSV (semicolon, header)
DEMOGRAPHICS_RAW = _strings(
    "City", "State", "Median Age", "Male Population", "Female Population", "Total Population",
    "Number of Veterans", "Foreign-born", "Average Household Size", "State Code", "Race", "Count",
)

#: the race values that become pivot columns (fixed values of the demographics source)
RACES = [
    "American Indian and Alaska Native",
    "Asian",
    "Black or African-American",
    "Hispanic or Latino",
    "White",
]

#: typed extract of the arrivals records; numerics are double as a SAS reader returns them
ARRIVALS = T.StructType([
    _f("cicid", T.DoubleType(), "entry record id"),
    _f("i94yr", T.DoubleType(), "arrival year"),
    _f("i94mon", T.DoubleType(), "arrival month"),
    _f("i94cit", T.DoubleType(), "country code of birth"),
    _f("i94res", T.DoubleType(), "country code of residence"),
    _f("i94port", T.StringType(), "port of entry code"),
    _f("arrdate", T.DoubleType(), "arrival day number, days since 1960-01-01"),
    _f("i94mode", T.DoubleType(), "1 air, 2 sea, 3 land, 9 not reported"),
    _f("i94bir", T.DoubleType(), "age in years"),
    _f("i94visa", T.DoubleType(), "1 business, 2 pleasure, 3 student"),
    _f("gender", T.StringType()),
    _f("airline", T.StringType()),
    _f("visatype", T.StringType()),
])

#: the parsed label file: one row per (format name, code)
FORMATS = T.StructType([
    _f("fmt", T.StringType(), "format (code list) name"),
    _f("code", T.StringType(), "code as written, quotes removed, trimmed"),
    _f("label", T.StringType(), "label text, quotes removed, trimmed"),
])

# ---------------------------------------------------------------- outputs (the contract)

FACT_ARRIVALS = T.StructType([
    _f("cicid", T.LongType(), "unique id of one arrival record"),
    _f("arrival_year", T.IntegerType(), "arrival year (yyyy)"),
    _f("arrival_month", T.IntegerType(), "arrival month number"),
    _f("arrival_date", T.DateType(), "arrival day"),
    _f("arrival_port_code", T.StringType(), "port of entry code"),
    _f("visitor_birth_country", T.IntegerType(), "country code of birth"),
    _f("visitor_residence_country", T.IntegerType(), "country code of residence"),
    _f("visitor_age", T.IntegerType(), "age in years"),
    _f("visitor_gender", T.StringType(), "gender as recorded"),
    _f("travel_mode_code", T.IntegerType(), "mode of travel code; 9 = not reported"),
    _f("travel_airline", T.StringType(), "carrier"),
    _f("travel_visa_type", T.StringType(), "class of admission"),
])

DIM_DATE = T.StructType([
    _f("arrival_date", T.DateType(), "calendar day"),
    _f("day", T.IntegerType(), "day of month"),
    _f("week", T.IntegerType(), "ISO week number"),
    _f("month", T.IntegerType(), "month number"),
    _f("year", T.IntegerType(), "calendar year"),
    _f("quarter", T.IntegerType(), "quarter number"),
])

DIM_TEMPERATURE_CITY = T.StructType([
    _f("year", T.IntegerType(), "year of the readings"),
    _f("month", T.IntegerType(), "month of the readings"),
    _f("city", T.StringType(), "city in the home country"),
    _f("average_temperature", T.DecimalType(4, 2), "monthly mean of whole-degree readings"),
])

DIM_TEMPERATURE_COUNTRY = T.StructType([
    _f("year", T.IntegerType(), "year of the readings"),
    _f("month", T.IntegerType(), "month of the readings"),
    _f("country", T.StringType(), "country other than the home country"),
    _f("average_temperature", T.DecimalType(4, 2), "monthly mean of whole-degree readings"),
])

DIM_DEMOGRAPHICS = T.StructType([
    _f("state", T.StringType(), "state name"),
    _f("state_code", T.StringType(), "two-letter state code"),
    _f("city", T.StringType(), "city name"),
    _f("median_age", T.DecimalType(4, 1), "median age of residents"),
    _f("male_population", T.IntegerType(), "male residents"),
    _f("female_population", T.IntegerType(), "female residents"),
    _f("total_population", T.IntegerType(), "all residents"),
    _f("number_of_veterans", T.IntegerType(), "veteran residents"),
    _f("number_of_foregn_born", T.IntegerType(), "residents born abroad"),
    _f("avarage_household_size", T.DecimalType(4, 2), "mean household size"),
    _f("american_indian_alaska_native", T.IntegerType(), "residents of this group"),
    _f("asian", T.IntegerType(), "residents of this group"),
    _f("black_or_africanamerican", T.IntegerType(), "residents of this group"),
    _f("hispanic_or_latino", T.IntegerType(), "residents of this group"),
    _f("white", T.IntegerType(), "residents of this group"),
])

DIM_COUNTRY = T.StructType([
    _f("country_code", T.IntegerType(), "numeric country code"),
    _f("country", T.StringType(), "country label"),
])

DIM_PORT = T.StructType([
    _f("port_code", T.StringType(), "port of entry code"),
    _f("city", T.StringType(), "place part of the port label"),
    _f("state_code", T.StringType(), "two-letter state code"),
    _f("state", T.StringType(), "state label"),
])

DIM_TRAVEL_MODE = T.StructType([
    _f("travel_mode_code", T.IntegerType(), "mode code"),
    _f("travel_mode", T.StringType(), "mode label"),
])

#: output name -> (schema, unique key, partition columns)
STAR = {
    "fact_i94_us_visitor_arrivals_table": (FACT_ARRIVALS, ["cicid"], ["arrival_year", "arrival_month"]),
    "dim_date_table": (DIM_DATE, ["arrival_date"], ["year", "month"]),
    "dim_temperatures_us_cities_table": (DIM_TEMPERATURE_CITY, ["year", "month", "city"], ["year", "month"]),
    "dim_temperatures_countries_table": (DIM_TEMPERATURE_COUNTRY, ["year", "month", "country"], ["year", "month"]),
    "dim_cities_demographic_table": (DIM_DEMOGRAPHICS, ["state", "city"], []),
    "dim_i94_country_table": (DIM_COUNTRY, ["country_code"], []),
    "dim_i94_port_table": (DIM_PORT, ["port_code"], []),
    "dim_i94_travel_mode_table": (DIM_TRAVEL_MODE, ["travel_mode_code"], []),
}

# ---------------------------------------------------------------- driver test tables

#: table -> unique key columns (used by the quality report)
DRIVER_KEYS = {
    "region": ["r_regionkey"],
    "nation": ["n_nationkey"],
    "customer": ["c_custkey"],
    "supplier": ["s_suppkey"],
    "part": ["p_partkey"],
    "orders": ["o_orderkey"],
    "lineitem": ["l_orderkey", "l_linenumber"],
    "events": ["event_id"],
    "documents": ["doc_id"],
    "embeddings": ["vec_id"],
    "pages": ["page_id"],
    "benchmark": ["item_id"],
    "labels": ["doc_id"],
    "conversations": ["conv_id", "turn"],
}
