"""Samples and splits of the events, which have a unique id."""

from __future__ import annotations

from pyspark.sql import functions as F

from bindings.base import EVENT_CLASSES, EVENTS_SQL, events, query
from flowguard.operators.sampling import (class_counts, imbalanced_sample, plan_sample, stratified_split,
                                          take_per_class, validate_sample)

SEED = 42
RANKED_SQL = "WITH " + EVENTS_SQL + """,
ranked AS (SELECT event_id, attack_type, "Label", count(*) OVER (PARTITION BY attack_type) AS n,
                  row_number() OVER (PARTITION BY attack_type ORDER BY md5('42|' || event_id)) AS place FROM ev)
"""


@query("imbalanced_sample", RANKED_SQL + """
SELECT event_id, attack_type, "Label" FROM ranked
WHERE place <= CASE WHEN "Label" = 0 THEN n // 2 ELSE n // 80 END""")
def _imbalanced_sample(spark, sf):
    """Half of the benign rows and every 80th of each attack class, drawn by hash."""
    t = events(spark, sf)
    counts = class_counts(t)
    quotas = {c: n // 2 if c == EVENT_CLASSES.benign else n // 80 for c, n in counts.items()}
    return take_per_class(t, quotas, SEED, "event_id", counts=counts).select("event_id", "attack_type", "Label")


def _drawn(spark, sf):
    t = events(spark, sf)
    return t, imbalanced_sample(t, "event_id", SEED, taxonomy=EVENT_CLASSES)


@query("imbalanced_sample_drawn")
def _imbalanced_sample_drawn(spark, sf):
    """The whole sampling rule: random attack total, jittered shares, scarce-benign scaling."""
    return _drawn(spark, sf)[1].groupBy("attack_type", "Label").agg(F.count(F.lit(1)).alias("n"))


@query("sample_validation", "WITH " + EVENTS_SQL + """,
c AS (SELECT count(*) FILTER ("Label" = 0) AS benign, count(DISTINCT attack_type) FILTER ("Label" = 1) AS kinds FROM ev),
f AS (SELECT benign, kinds, least(1.0, benign / 200000) AS share FROM c),
l AS (SELECT *, CAST(greatest(4, round_even(4000 * share, 0)) AS BIGINT) AS attack_low FROM f)
SELECT least(benign, 200000) AS n_benign, attack_low,
       CAST(greatest(attack_low, round_even(6200 * share, 0)) AS BIGINT) AS attack_high,
       true AS benign_exact, true AS attack_within, kinds = 4 AS all_classes FROM l""")
def _sample_validation(spark, sf):
    """The checks of a drawn sample, with the bounds that the scarce benign rows leave."""
    t, sample = _drawn(spark, sf)
    spec = plan_sample(class_counts(t), SEED, 200_000, 4_000, 6_200, EVENT_CLASSES)
    checked = validate_sample(sample, spec, EVENT_CLASSES)
    bounds = F.col("n_attack").between(spec.attack_min, spec.attack_max)
    return checked.select("n_benign", F.lit(spec.attack_min).cast("long").alias("attack_low"),
                          F.lit(spec.attack_max).cast("long").alias("attack_high"), "benign_exact",
                          bounds.alias("attack_within"), "all_classes")


@query("stratified_split", RANKED_SQL + """
SELECT event_id, CASE WHEN place <= floor(0.7 * n + 0.5) THEN 'train'
                      WHEN place <= floor(0.85 * n + 0.5) THEN 'val' ELSE 'test' END AS split FROM ranked""")
def _stratified_split(spark, sf):
    split = stratified_split(events(spark, sf), {"train": 0.7, "val": 0.15, "test": 0.15}, "event_id", SEED)
    return split.select("event_id", "split")
