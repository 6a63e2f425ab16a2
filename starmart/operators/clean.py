"""Cleaning operators: required columns, typed projection, deterministic de-duplication."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

def quote(name: str) -> str:
    """Backtick-quote a column name so blanks, dots and dashes are taken literally."""
    return "`" + name.replace("`", "``") + "`"


def col(name: str) -> Column:
    return F.col(quote(name))


def require(df: DataFrame, cols: Sequence[str] | None = None) -> DataFrame:
    """Keep rows where every listed column (default: all) is non-null and not NaN.

    One ``na.drop`` replaces the reference's chains of ``isNotNull`` filters; Catalyst merges
    it with any later not-null tests and pushes it into the scan.
    """
    return df.na.drop(how="any", subset=list(cols) if cols is not None else None)


def project(df: DataFrame, schema: T.StructType, mapping: Mapping[str, str | Column] | None = None
            ) -> DataFrame:
    """Typed projection onto ``schema``.

    ``mapping`` gives the source column (name or expression) of an output field; a field not
    in it is taken from the column of the same name (case-insensitive, as Spark resolves).
    Every cast is a ``try_cast``: text that does not fit the type becomes null instead of
    failing the job under ANSI mode.  Field comments are kept as column metadata.
    """
    mapping = dict(mapping or {})
    out = []
    for field in schema.fields:
        src = mapping.get(field.name, field.name)
        expr = col(src) if isinstance(src, str) else src
        out.append(expr.try_cast(field.dataType).alias(field.name, metadata=field.metadata))
    return df.select(*out)


def _descending_key(c: Column, dtype: T.DataType) -> Column:
    """A key whose ascending order is ``c`` descending (numbers, times, text, bytes, booleans)."""
    if isinstance(dtype, T.IntegralType):
        return F.bitwise_not(c)  # -c would overflow for the smallest number
    if isinstance(dtype, (T.FloatType, T.DoubleType)):
        return F.struct(~F.isnan(c), -c)  # NaN is the largest number
    if isinstance(dtype, T.DecimalType):
        return -c
    if isinstance(dtype, T.DateType):
        return F.datediff(F.lit("1970-01-01").cast("date"), c)
    if isinstance(dtype, T.TimestampType):
        return F.bitwise_not(F.unix_micros(c))  # instants: a repeated local hour does not tie
    if isinstance(dtype, T.TimestampNTZType):
        days = F.datediff(c.cast("date"), F.lit("1970-01-01").cast("date")).cast("decimal(20,6)")
        secs = (days * 86400 + F.hour(c) * 3600 + F.minute(c) * 60
                + F.date_part(F.lit("SECOND"), c))
        return -secs
    if isinstance(dtype, T.BooleanType):
        return ~c
    if isinstance(dtype, (T.StringType, T.BinaryType)):
        # the bytes' complement; the closing mark, above all digits, puts a prefix behind
        digits = "0123456789ABCDEF"
        return F.concat(F.translate(F.hex(c), digits, digits[::-1]), F.lit("G"))
    raise TypeError(f"cannot order {dtype.simpleString()} against the leading direction")


def dedupe(df: DataFrame, keys: Sequence[str],
           order: Iterable[tuple[str, bool]] | None = None) -> DataFrame:
    """One row per key, chosen deterministically.

    ``order`` lists ``(column, ascending)`` pairs; the first row in that order wins, nulls last,
    and all remaining columns break ties (in the direction of the first ``order`` column,
    ascending when ``order`` is empty), so the result never depends on partitioning or task
    timing (and a re-run after a lost executor gives the same rows).

    Built as a grouped ``min``/``max`` over a struct instead of ``row_number`` over a window: the
    aggregate combines map-side, so a key holding a third of all rows is reduced to one row per
    input partition before the shuffle, where a window would sort that whole key in one task.
    When the keys are all the columns this is simply ``distinct()``.
    """
    keys = list(keys)
    others = [c for c in df.columns if c not in keys]
    if not others:
        return df.distinct()
    order = list(order or [])
    order_names = [c for c, _ in order]
    rest = [c for c in others if c not in order_names]
    lead_asc = order[0][1] if order else True
    spec = order + [(c, lead_asc) for c in rest]
    types = {f.name: f.dataType for f in df.schema.fields}
    fields, source = [], {}
    for i, (name, asc) in enumerate(spec):
        c = col(name)
        # nulls last in both directions: min prefers isNull=false, max prefers isNotNull=true
        flag = c.isNull() if lead_asc else c.isNotNull()
        if asc == lead_asc:
            key = c
            source[name] = f"_k{i}"          # the sort key is the value itself
        else:
            key = _descending_key(c, types[name])
        fields += [flag.alias(f"_n{i}"), key.alias(f"_k{i}")]
    # only transformed columns travel a second time, as raw values
    extra = [c for c in others if c not in source]
    for j, name in enumerate(extra):
        fields.append(col(name).alias(f"_v{j}"))
        source[name] = f"_v{j}"
    best = F.struct(*fields)
    agg = F.min(best) if lead_asc else F.max(best)
    picked = df.groupBy(*[col(k) for k in keys]).agg(agg.alias("_best"))
    return picked.select(*[col(k) for k in keys],
                         *[F.col("_best").getField(source[c]).alias(c) for c in others]
                         ).select(*[col(c) for c in df.columns])
