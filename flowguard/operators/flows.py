"""Collapse time-segmented flow records into one row per flow."""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.operators.keys import require_columns
from flowguard.taxonomy import ENDPOINT_COLUMNS, TRAFFIC, Taxonomy

# Aggregation of the known segment columns.
SEGMENT_POLICY = {
    "flow_duration": "sum", "total_packets": "sum", "total_bytes": "sum",
    "fwd_packets": "sum", "bwd_packets": "sum", "syn_count": "sum", "ack_count": "sum",
    "fin_count": "sum", "rst_count": "sum", "psh_count": "sum", "header_len_total": "sum",
    "pkt_len_max": "max", "flow_packets_per_s": "max", "flow_bytes_per_s": "max",
    "pkt_len_min": "min",
    "pkt_len_mean": "mean", "pkt_len_std": "mean", "iat_mean": "mean", "iat_std": "mean",
    "down_up_ratio": "mean",
    "protocol": "first",
}

# Whole words of a name, singular, and what they say.
MEAN_TOKENS = frozenset("rate mean average avg std deviation variance var ratio percent".split())
SUM_TOKENS = frozenset("tot total count cnt duration byte packet pkt flag".split())
END_TOKENS = {"max": "max", "maximum": "max", "maximal": "max", "min": "min", "minimum": "min", "minimal": "min"}


def name_tokens(column: str) -> list[str]:
    """Words of a column name, in lower case and without a plural s: ``FlowBytes/s`` is flow,
    byte, /s."""
    words = re.findall(r"/s\b|[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+", column)
    return [w if w == "/s" or len(w) < 4 else w.removesuffix("s") for w in (w.lower() for w in words)]


def infer_policy(column: str, rules: str = "named") -> str:
    """Aggregation of a column chosen from the words of its name: sum, max, min or mean.

    Means go before extremes and those before sums. ``rules="named"`` wants max/min at either
    end of the name, ``"short"`` anywhere, and sums lengths as well.
    """
    tokens = name_tokens(column)
    if "/s" in tokens or not MEAN_TOKENS.isdisjoint(tokens) or tokens[-2:] == ["per", "s"]:
        return "mean"
    ends = [END_TOKENS.get(t) for t in (tokens if rules == "short" else tokens[:1] + tokens[-1:])]
    extreme = next((e for e in ends if e), None)
    if extreme:
        return extreme
    sums = SUM_TOKENS | {"len", "length"} if rules == "short" else SUM_TOKENS
    return "mean" if sums.isdisjoint(tokens) else "sum"


def first_value(c: Column, order: Column | None, whole: bool = False) -> Column:
    """First non-null value in the given order, the smallest value without one.

    Numbers keep this a hash aggregation. Where the order and the values are ``whole`` numbers,
    equal places of a key give the smallest value: both stand in one decimal, the place first.
    Otherwise equal places may give any of their values.
    """
    if order is None:
        return F.min(c)
    if whole:
        order = order.cast("decimal(18,0)") * F.lit(str(1 << 64)).cast("decimal(20,0)") + c.cast("decimal(19,0)")
    return F.min_by(c, F.when(c.isNotNull(), order))


def first_texts(df: DataFrame, key: str, columns: list[str], order: Column | None) -> DataFrame:
    """key and text columns of its first row that has them all, or of its first row.

    An aggregate over text would sort the whole input. Here the texts are grouping keys of a
    first hash aggregation, which leaves a row or two per flow, and only numbers are compared.
    """
    lacking = F.lit(False)
    for c in columns:
        lacking = lacking | F.col(c).isNull()
    place = (F.lit(0) if order is None else order).cast("double")
    seen = df.groupBy(key, *columns).agg(F.min(place).alias("_place")).withColumns({
        "_place": F.coalesce("_place", F.lit(float("inf"))) + F.when(lacking, F.lit(float("inf"))).otherwise(0.0),
        "_tie": F.xxhash64(*columns)})
    least = seen.groupBy(key).agg(F.min("_place").alias("_place"))
    tied = seen.join(least, [key, "_place"])
    one = tied.groupBy(key).agg(F.min("_tie").alias("_tie"))
    return tied.join(one, [key, "_tie"]).select(key, *columns)


def class_names(df: DataFrame, attack_type: str = "attack_type") -> list[str]:
    """The distinct classes."""
    return sorted(r[0] for r in df.select(attack_type).where(F.col(attack_type).isNotNull()).distinct().collect())


def _majority(names: list[str], counts: list[Column]) -> Column:
    """Name of the largest count; on a tie the lowest name."""
    top = F.greatest(*counts) if len(counts) > 1 else counts[0]
    result = None
    for name, n in sorted(zip(names, counts), key=lambda p: p[0]):
        test = (n == top) & (n > 0)
        result = F.when(test, name) if result is None else result.when(test, name)
    return result


def majority_class(df: DataFrame, key: str = "flow_id", attack_type: str = "attack_type",
                   classes: list[str] | None = None) -> DataFrame:
    """Most frequent class per key, the lowest name on a tie: one hash aggregation of a counter
    per class, so a huge key never meets in one task uncombined."""
    classes = classes or class_names(df, attack_type)
    if not classes:
        return df.select(key, F.lit(None).cast("string").alias(attack_type)).distinct()
    counted = df.groupBy(key).agg(*_class_counters(attack_type, classes))
    columns = [F.col(f"_c{i}") for i in range(len(classes))]
    return counted.select(key, _checked_majority(classes, columns).alias(attack_type))


def _class_counters(attack_type: str, classes: list[str]) -> list[Column]:
    c = F.col(attack_type)
    return ([F.count_if(c == name).alias(f"_c{i}") for i, name in enumerate(classes)]
            + [F.count_if(c.isNotNull() & ~c.isin(classes)).alias("_other")])


def _checked_majority(classes: list[str], columns: list[Column]) -> Column:
    complaint = F.raise_error(F.lit("a class outside the given list occurs")).cast("string")
    return F.when(F.col("_other") > 0, complaint).otherwise(_majority(classes, columns))


def unify_flows(df: DataFrame, key: str = "flow_id", label: str = "Label",
                attack_type: str = "attack_type", policy: dict[str, str] | None = None,
                rules: str = "named", order: str | None = None,
                id_columns: tuple[str, ...] = ENDPOINT_COLUMNS,
                skip: tuple[str, ...] = ("segment_index",),
                classes: list[str] | None = None,
                taxonomy: Taxonomy = TRAFFIC) -> DataFrame:
    """One record per flow.

    Numeric columns are combined by ``policy``, or by a rule on their name when not listed;
    text columns are left out; id columns keep their first non-null value in ``order``.
    ``Label`` is 1 if any segment is an attack, ``attack_type`` is the majority class and
    ``label_conflict`` marks flows where the two disagree.

    Everything is a ``groupBy`` with partial aggregation, so a flow with very many
    segments is combined before the shuffle. Class counters and numbers keep it a hash
    aggregation; text id columns are found on the side (``first_texts``). Pass ``classes`` to
    spare the pass that lists them. Policy names match whatever their case.
    """
    require_columns(df, [key, label, attack_type])
    policy = SEGMENT_POLICY if policy is None else policy
    classes = classes or class_names(df, attack_type)
    by = F.col(order) if order else None
    combine = {"sum": F.sum, "max": F.max, "min": F.min, "mean": F.avg}
    known = {name.lower(): how for name, how in policy.items()}

    def first(c: Column, name: str) -> Column:
        return first_value(c, by, order is not None and all(isinstance(df.schema[n].dataType, T.IntegralType) for n in (order, name)))

    aggs = []
    taken = {key, label, attack_type, *id_columns, *skip}
    for field in df.schema.fields:
        if field.name in taken or not isinstance(field.dataType, T.NumericType):
            continue
        how = known.get(field.name.lower()) or infer_policy(field.name, rules)
        c = F.col(f"`{field.name}`")
        aggs.append((first(c, field.name) if how == "first" else combine[how](c)).alias(field.name))
    aggs += [F.max(label).alias(label), F.count(F.lit(1)).alias("n_segments")]
    ids = [c for c in id_columns if c in df.columns]
    text_ids = [c for c in ids if isinstance(df.schema[c].dataType, T.StringType)]
    aggs += [first(F.col(c), c).alias(c) for c in ids if c not in text_ids]

    counters = _class_counters(attack_type, classes) if classes else []
    out = df.groupBy(key).agg(*aggs, *counters)
    columns = [F.col(f"_c{i}") for i in range(len(classes))]
    name = _checked_majority(classes, columns) if classes else F.lit(None).cast("string")
    out = out.withColumn(attack_type, name).drop("_other", *[f"_c{i}" for i in range(len(classes))])
    if text_ids:
        out = out.join(first_texts(df, key, text_ids, by), key, "left")
    conflict = (F.col(label) == 1) & (F.col(attack_type) == taxonomy.benign)
    return out.withColumn("label_conflict", F.coalesce(conflict.cast("int"), F.lit(0)))


def segment_stats(unified: DataFrame) -> DataFrame:
    """Number of flows and of flows with more than one segment."""
    return unified.agg(F.count(F.lit(1)).alias("n_unified_flows"),
                       F.count_if(F.col("n_segments") > 1).alias("multi_segment_flows"))
