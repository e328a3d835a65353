"""Running flow records with bounded state: a record leaves when its flow has been idle.

Segments of a micro-batch are first combined per task, then meet the open records of their flow.
Two segments belong to one record if no pause between them is longer than the idle time, whatever
batch they came in. A record is emitted, and its state freed, once the watermark has passed its
last segment by the idle time, also for flows that nothing follows. A record is a session
window, so segments and state stay in Spark's own operators.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from flowguard.operators.flows import SEGMENT_POLICY, infer_policy
from flowguard.taxonomy import TRAFFIC, Taxonomy

ROCKS = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
PROVIDER = "spark.sql.streaming.stateStore.providerClass"


def use_state_store(df: DataFrame) -> None:
    """Open records may outgrow the memory, so they go to the RocksDB store; a store that the session
    names itself stays."""
    spark = df.sparkSession
    if "HDFSBacked" in spark.conf.get(PROVIDER, "HDFSBacked"):
        spark.conf.set(PROVIDER, ROCKS)


def stream_flow_records(segments: DataFrame, ts: str, idle_seconds: float, classes: list[str], key: str = "flow_id",
                        label: str = "Label", attack_type: str = "attack_type", policy: dict[str, str] | None = None,
                        id_columns: tuple[str, ...] = (), skip: tuple[str, ...] = (), watermark: str = "0 seconds",
                        taxonomy: Taxonomy = TRAFFIC) -> DataFrame:
    """Closed flow records of a stream of segments, in append mode.

    Columns are combined as ``unify_flows`` does in one batch; id columns keep their least value.
    Rows without a key or time are no segments. A segment is dropped if the watermark has passed it by
    the idle time; one that is late by less joins its record if that is still open.
    """
    known = {name.lower(): how for name, how in (SEGMENT_POLICY if policy is None else policy).items()}
    taken = {key, label, attack_type, ts, *skip}
    columns = {f.name: "min" if f.name in id_columns else known.get(f.name.lower()) or infer_policy(f.name)
               for f in segments.schema.fields if f.name not in taken and isinstance(f.dataType, T.NumericType)}
    columns = {c: "min" if how == "first" else how for c, how in columns.items()}
    whole = [c for c, how in columns.items() if how != "mean" and isinstance(segments.schema[c].dataType, T.IntegralType)]
    use_state_store(segments)
    # A large flow meets as one record a task, not segment by segment.
    segments.sparkSession.conf.set("spark.sql.streaming.sessionWindow.merge.sessions.in.local.partition", "true")

    raw = segments.where(F.col(ts).isNotNull()).select(
        F.col(key).alias("flow"), F.col(ts).cast("timestamp").alias("seen"), F.col(label).cast("long").alias("label"),
        F.col(attack_type).alias("class"), *[_value(c, c in whole).alias(f"v_{c}") for c in columns])
    # A row without a key only moves the watermark. The time in the condition keeps it behind the watermark.
    timed = raw.withWatermark("seen", watermark).where(F.when(F.col("seen").isNotNull(), F.col("flow").isNotNull()))
    # Windows that touch are one, so a pause as long as the idle time does not part a record.
    pause = F.session_window("seen", f"{int(idle_seconds * 1_000_000)} microseconds")
    known_class = F.col("class").isin(list(classes))
    records = timed.groupBy("flow", pause.alias("open")).agg(
        F.min("seen").alias("record_start"), F.max("seen").alias("record_end"), F.max("label").alias("label"),
        F.count(F.lit(1)).alias("n"), *[COMBINED[how](f"v_{c}").alias(f"v_{c}") for c, how in columns.items()],
        *[F.count_if(F.col("class") == name).alias(f"k_{i}") for i, name in enumerate(classes)],
        F.count_if(F.col("class").isNotNull() & ~known_class).alias("k_other"))
    return finished(records, key, list(columns), list(classes), label, attack_type, taxonomy)


COMBINED = {"sum": F.sum, "min": F.min, "max": F.max, "mean": F.avg}


def _value(column: str, whole: bool) -> Column:
    """A number of a segment; NaN is a missing one."""
    if whole:
        return F.col(column).cast("long")
    number = F.col(column).cast("double")
    return F.when(~F.isnan(number), number)


def finished(records: DataFrame, key: str, columns: list[str], classes: list[str], label: str, attack_type: str,
             taxonomy: Taxonomy) -> DataFrame:
    """Closed session windows as records."""
    counts = [F.col(f"k_{i}") for i in range(len(classes))]
    complaint = F.raise_error(F.lit("a class outside the given list occurs")).cast("string")
    name = F.when(F.col("k_other") > 0, complaint)
    top = F.greatest(*counts) if len(counts) > 1 else counts[0]
    for c, n in sorted(zip(classes, counts), key=lambda p: p[0]):
        name = name.when((n == top) & (n > 0), F.lit(c))
    conflict = (F.col(label) == 1) & (F.col(attack_type) == taxonomy.benign)
    return records.select(
        F.col("flow").alias(key), "record_start", "record_end", *[F.col(f"v_{c}").alias(c) for c in columns],
        F.col("label").cast("int").alias(label), F.col("n").alias("n_segments"), name.alias(attack_type)
    ).withColumn("label_conflict", F.coalesce(conflict.cast("int"), F.lit(0)))
