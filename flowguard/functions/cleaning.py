"""Column expressions that clean numbers, ports and endpoints."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLANKS = " \t\n\r\x0b\x0c"


def finite(c: Column) -> Column:
    """NULL in place of NaN and +-Inf. Needed before any quantile or ``greatest``: Spark
    orders NaN above every number."""
    c = c.cast("double")
    return F.when(~F.isnan(c) & (F.abs(c) != F.lit(float("inf"))), c)


def number(name: str, dtype: T.DataType) -> Column:
    """A column as a finite double; text that is no number becomes NULL."""
    c = F.col(f"`{name}`")
    return finite(c.try_cast("double") if isinstance(dtype, T.StringType) else c)


def clean_numeric(df: DataFrame, columns: list[str]) -> DataFrame:
    """Replace NaN and +-Inf by NULL in the given columns."""
    types = {f.name: f.dataType for f in df.schema.fields}
    return df.withColumns({c: number(c, types[c]) for c in columns})


def port_text(port: Column) -> Column:
    """A port as integer text: '80.0' -> '80', unreadable or missing -> '-1'."""
    whole = finite(port.try_cast("double")).try_cast("bigint")
    return F.coalesce(whole, F.lit(-1)).cast("string")


def endpoint(ip: Column, port: Column) -> Column:
    """``ip:port`` text; a missing address is written ``na``."""
    address = F.btrim(F.coalesce(ip.cast("string"), F.lit("na")), F.lit(BLANKS))
    return F.concat(address, F.lit(":"), port_text(port))


def flow_key(src_ip: Column, src_port: Column, dst_ip: Column, dst_port: Column) -> Column:
    """Direction-free flow key: both endpoints in ascending order, joined by ``-``.

    Nulls are filled inside ``endpoint`` first, because ``least`` skips nulls.
    """
    a, b = endpoint(src_ip, src_port), endpoint(dst_ip, dst_port)
    return F.concat_ws("-", F.least(a, b), F.greatest(a, b))


def log1p(c: Column) -> Column:
    return F.log1p(c)


def reached(score: Column, threshold: Column | float) -> Column:
    """1 when the score is at or above the threshold, else 0; NULL scores give 0."""
    return F.coalesce((score >= threshold).cast("int"), F.lit(0))


def ratio(top: Column, bottom: Column) -> Column:
    """top / bottom as double, 0 when the denominator is 0."""
    return F.coalesce(F.try_divide(top.cast("double"), bottom.cast("double")), F.lit(0.0))
