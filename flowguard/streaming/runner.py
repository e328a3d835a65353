"""File streams in and out, run until the input present is used up."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery
from pyspark.sql.types import StructType

from flowguard.session import shared_dir


def stream_table(spark: SparkSession, folder: str, name: str, schema: StructType | None = None,
                 files_per_trigger: int | None = None) -> DataFrame:
    """A parquet file (or files matching ``name``) of a folder as a stream."""
    schema = schema or spark.read.parquet(f"{folder}/{name}").schema
    reader = spark.readStream.schema(schema).option("pathGlobFilter", name)
    if files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", files_per_trigger)
    return reader.parquet(folder)


def replay(df: DataFrame, ts: str, batches: int, purpose: str, close_after: str | None = None, files: int = 1) -> str:
    """A table written as a folder of files in the order of time, ``files`` for each of ``batches``
    equal spans of time, to be read as a stream of as many micro-batches. With ``close_after`` a last
    file has one row, null but for a time that much after the end, which closes what is still open.
    Rows without a time come first.
    """
    folder = shared_dir(df.sparkSession, purpose)
    at = F.unix_micros(F.col(ts).cast("timestamp"))
    low, high, end = df.agg(F.min(at), F.max(at), F.max(ts)).first()
    if low is not None:
        step = (high - low) // batches + 1
        for k in range(batches):
            inside = (at >= low + k * step) & (at < low + (k + 1) * step)
            df.where(inside if k else inside | F.col(ts).isNull()).repartition(files).write.mode("append").parquet(folder)
        if close_after:
            last = F.lit(end).cast(df.schema[ts].dataType) + F.expr(f"INTERVAL {close_after}")
            row = df.sparkSession.range(1).select(*[(last if c == ts else F.lit(None)).cast(df.schema[c].dataType).alias(c) for c in df.columns])
            row.coalesce(1).write.mode("append").parquet(folder)
    else:
        df.coalesce(1).write.parquet(folder)
    return folder


def start(stream: DataFrame, write: Callable[[DataFrame, int], None], mode: str, work: str,
          available_now: bool = True, **trigger) -> StreamingQuery:
    writer = (stream.writeStream.outputMode(mode).foreachBatch(write)
              .option("checkpointLocation", f"{work}/checkpoint"))
    return writer.trigger(**({"availableNow": True} if available_now else trigger)).start()


def _batch_writer(out: str) -> Callable[[DataFrame, int], None]:
    def write(batch: DataFrame, batch_id: int) -> None:
        # One folder per batch, overwritten when a failed batch is run again.
        batch.write.mode("overwrite").parquet(f"{out}/batch_id={batch_id}")
    return write


def run_append(stream: DataFrame, purpose: str) -> DataFrame:
    """Run a stream whose rows are final when written, and return them as a table."""
    spark = stream.sparkSession
    work = shared_dir(spark, purpose)
    start(stream, _batch_writer(f"{work}/out"), "append", work).awaitTermination()
    return spark.read.schema(_written_schema(stream)).parquet(f"{work}/out").drop("batch_id")


def run_update(stream: DataFrame, keys: list[str], purpose: str) -> DataFrame:
    """Run an aggregation in update mode and return the last state of every key.

    Each batch writes only the groups it changed; the newest version per key is picked when
    reading. Unlike complete mode no batch writes the whole result again.
    """
    spark = stream.sparkSession
    work = shared_dir(spark, purpose)
    start(stream, _batch_writer(f"{work}/out"), "update", work).awaitTermination()
    written = spark.read.schema(_written_schema(stream)).parquet(f"{work}/out")
    newest = F.max_by(F.struct(*stream.columns), "batch_id").alias("s")
    return written.groupBy(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)]) \
                  .agg(newest).select("s.*")


def _written_schema(stream: DataFrame) -> StructType:
    return StructType(list(stream.schema.fields)).add("batch_id", "long")
