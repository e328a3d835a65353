"""Fits whose tasks run at the same time, keep their rows in memory and add up arrays in between.

A step of boosting or of a network needs one sum over all rows. As a Spark job of its own such a step costs far more
than its sum, so a fit is one barrier stage: its tasks exchange their parts through a folder below
``spark.checkpoint.dir``, and each takes the same step from the same sum. A task that is lost runs the stage again.
"""

from __future__ import annotations

import os
import time
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession

from flowguard.session import shared_dir

#: Tasks of a fit at most: each reads the parts of all others.
MOST_TASKS = 32
#: Seconds without a part of another task after which a task gives up.
PATIENCE = 1_800.0

STATE = "name string, dtype string, shape array<long>, data binary"


def concurrent_tasks(spark: SparkSession) -> int:
    """Tasks that can run at the same time now."""
    context = spark.sparkContext._jsc.sc()
    return max(1, context.maxNumConcurrentTasks(context.resourceProfileManager().defaultResourceProfile()))


class Sums:
    """Sums of arrays over the tasks of a stage; the parts are added in the order of the tasks, so every task gets the
    same bits."""

    def __init__(self, folder: str = "", rank: int = 0, size: int = 1):
        self.rank, self.size, self.turn = rank, size, 0
        if size > 1:
            self.store, self.path = place(folder)
            self.store.create_dir(self.path)

    def __call__(self, part: np.ndarray) -> np.ndarray:
        if self.size == 1:
            return part
        part = np.ascontiguousarray(part, dtype="float64")
        self._write(part)
        total = np.zeros(part.size)
        for rank in range(self.size):
            total += part.ravel() if rank == self.rank else self._read(rank)
        if self.turn > 1:  # all have read it, as they have written the next one
            self.store.delete_file(self._name(self.turn - 2, self.rank))
        self.turn += 1
        return total.reshape(part.shape)

    def _name(self, turn: int, rank: int) -> str:
        return f"{self.path}/{turn}-{rank}"

    def _write(self, part: np.ndarray) -> None:
        name = self._name(self.turn, self.rank)
        with self.store.open_output_stream(f"{name}.part") as out:
            out.write(part.tobytes())
        self.store.move(f"{name}.part", name)

    def _read(self, rank: int) -> np.ndarray:
        name, pause, until = self._name(self.turn, rank), 0.0002, time.monotonic() + PATIENCE
        while True:
            try:
                with self.store.open_input_file(name) as source:
                    return np.frombuffer(source.read())
            except FileNotFoundError:
                if time.monotonic() > until:
                    raise TimeoutError(f"no part of task {rank} in {PATIENCE:.0f} s") from None
                time.sleep(pause)
                pause = min(1.2 * pause, 0.01)


def place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


def fit_together(df: DataFrame, rows: int, rows_per_task: int,
                 work: Callable[[Iterator[pa.RecordBatch], Sums], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """``work`` in as many tasks as ``rows`` need and can run at once. Each gets its part of the table and a ``Sums``;
    all must ask for the same sums. The arrays of the first task are returned. Where the shared folder is out of reach
    of pyarrow, one task takes all rows."""
    spark = df.sparkSession
    tasks = max(1, min(-(-rows // rows_per_task), MOST_TASKS, concurrent_tasks(spark)))
    folder = shared_dir(spark, "together") if tasks > 1 else ""
    try:
        place(folder)
    except (OSError, ValueError, pa.ArrowException):
        tasks = 1

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = Sums()
        if tasks > 1:
            from pyspark import BarrierTaskContext
            context = BarrierTaskContext.get()
            # A stage that is run again has a folder of its own.
            run_id = context.allGather(uuid.uuid4().hex)[0]
            sums = Sums(os.path.join(folder, run_id), context.partitionId(), tasks)
        state = work(batches, sums)
        if sums.rank == 0:
            yield pa.RecordBatch.from_pydict({
                "name": list(state), "dtype": [str(a.dtype) for a in state.values()],
                "shape": pa.array([list(a.shape) for a in state.values()], pa.list_(pa.int64())),
                "data": pa.array([a.tobytes() for a in state.values()], pa.binary())})

    try:
        found = df.repartition(tasks).mapInArrow(run, STATE, barrier=tasks > 1).collect()
    finally:
        if tasks > 1:
            where = spark._jvm.org.apache.hadoop.fs.Path(folder)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)
    return {r["name"]: np.frombuffer(r["data"], r["dtype"]).reshape(r["shape"]).copy() for r in found}
