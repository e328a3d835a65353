"""Identifier columns: trimmed headers, alias renames, the flow key and column guards."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from flowguard.functions.cleaning import flow_key
from flowguard.functions.labels import squeeze
from flowguard.taxonomy import ENDPOINT_COLUMNS, ID_ALIASES


class MissingColumnError(ValueError):
    """A required column is absent."""


def trim_headers(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip() for c in df.columns])


def rename_ids(df: DataFrame) -> DataFrame:
    """Give identifier columns their canonical names. A canonical name already present is
    left alone; otherwise the first column whose spelling matches wins."""
    renames: dict[str, str] = {}
    for canonical, spellings in ID_ALIASES.items():
        if canonical in df.columns:
            continue
        found = next((c for c in df.columns if c not in renames and squeeze(c) in spellings), None)
        if found is not None:
            renames[found] = canonical
    return df.withColumnsRenamed(renames)


def require_columns(df: DataFrame, columns: list[str]) -> None:
    absent = [c for c in columns if c not in df.columns]
    if absent:
        raise MissingColumnError(f"missing column(s) {absent}; have {df.columns[:30]}")


def ensure_flow_id(df: DataFrame) -> DataFrame:
    """Add the direction-free ``flow_id``.

    It is rebuilt whenever both endpoints are there, since exported flow ids carry the
    protocol and a direction and would not match between packets and flows.
    """
    df = rename_ids(df)
    if all(c in df.columns for c in ENDPOINT_COLUMNS):
        src_ip, dst_ip, src_port, dst_port = (F.col(c) for c in ENDPOINT_COLUMNS)
        return df.withColumn("flow_id", flow_key(src_ip, src_port, dst_ip, dst_port))
    require_columns(df, ["flow_id"])
    return df


def union_by_name(frames: list[DataFrame]) -> DataFrame:
    """Union all, matching columns by name; a column some frames lack is NULL there."""
    if not frames:
        raise ValueError("nothing to union")
    out = frames[0]
    for other in frames[1:]:
        out = out.unionByName(other, allowMissingColumns=True)
    return out
