"""What the operators of this package share: scratch tables, inputs, byte-level words."""

from __future__ import annotations

import struct
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from contextvars import ContextVar

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from flowguard.session import shared_dir

#: Bytes of UTF-8 text that a numpy pass takes at once; a longer text is a pass of its own.
BLOCK = 4 << 20
#: Bytes of an Arrow batch whose rows hold whole texts.
BATCH_BYTES = 8 << 20

LOWER = bytes(b + 32 if 65 <= b <= 90 else b for b in range(256))
ALNUM = bytes(b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
               for b in range(256))


def stage(df: DataFrame, purpose: str) -> DataFrame:
    """``df`` written to the shared folder and read again: lineage ends here, lost executors
    cost only the tasks that were running. The folder goes when the session ends."""
    spark, path = df.sparkSession, shared_dir(df.sparkSession, purpose)
    df.write.parquet(path)
    delete_at_exit(spark, path)
    if (made := _MADE.get()) is not None:
        made[path] = purpose
    return spark.read.schema(df.schema).parquet(path)


_MADE: ContextVar[dict[str, str] | None] = ContextVar("made", default=None)


@contextmanager
def scratch(spark: SparkSession, *kept: str) -> Iterator[None]:
    """Tables staged inside are deleted at the end, but for those of the purposes ``kept``: what is
    handed out may read no others."""
    made: dict[str, str] = {}
    token = _MADE.set(made)
    try:
        yield
    finally:
        _MADE.reset(token)
    for path, purpose in made.items():
        if purpose not in kept:
            where = spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(spark._jsc.hadoopConfiguration()).delete(where, True)


def delete_at_exit(spark: SparkSession, path: str) -> None:
    jvm = spark._jvm
    where = jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsc.hadoopConfiguration()).deleteOnExit(where)


@contextmanager
def bounded_batches(spark: SparkSession, size: int = BATCH_BYTES) -> Iterator[None]:
    """Arrow batches of at most ``size`` bytes for the jobs inside; the session's setting comes back."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    before = spark.conf.get(key)
    spark.conf.set(key, str(size))
    try:
        yield
    finally:
        spark.conf.set(key, before)


def id_and_text(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the two columns an operator works on, so other columns never clash with its own."""
    return docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).cast("string").alias("text"))


def quoted(name: str) -> str:
    """A column name as ``F.col`` takes it, whatever it holds."""
    return "`" + name.replace("`", "``") + "`"


def unused(columns: list[str], *names: str) -> list[str]:
    """``names`` with underscores in front until no column is called so."""
    taken = {c.lower() for c in columns}
    out = []
    for name in names:
        while name in taken:
            name = "_" + name
        out.append(name)
    return out


def let(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once."""
    return F.transform(F.array(value), use)[0]


def parts(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def lower_words(text: str | None) -> list[bytes]:
    """Words between ASCII white space, A-Z lowered."""
    return text.encode().translate(LOWER).split() if text else []


def alnum_words(text: str | None) -> list[bytes]:
    """Runs of ASCII letters, digits and non-ASCII characters, A-Z lowered."""
    return text.encode().translate(ALNUM).split() if text else []


def word_bounds(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends of the words of translated text, where bytes up to the space separate."""
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = data > 32
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def joined(values: list[str | None], lowered: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Texts as one byte array with a space after each, and the bounds of the texts in it."""
    raw = [v.encode() if v else b"" for v in values]
    bounds = np.cumsum([0, *(len(r) + 1 for r in raw)])
    return np.frombuffer((b" ".join(raw) + b" ").translate(lowered), np.uint8), bounds


def texts(batches: Iterator[pa.RecordBatch], limit: int = BLOCK) -> Iterator[tuple[list, list]]:
    """Ids and texts in groups of at most ``limit`` bytes (one text at least)."""
    ids, held, size = [], [], 0
    for batch in batches:
        column, keys = batch.column("text"), batch.column("doc_id").to_pylist()
        for i, key in enumerate(keys):
            value = column[i].as_py()
            n = len(value) if value else 0
            if ids and size + n > limit:
                yield ids, held
                ids, held, size = [], [], 0
            ids.append(key)
            held.append(value)
            size += n
    if ids:
        yield ids, held


def squeezed(docs: DataFrame, chosen: Callable[[pa.RecordBatch], np.ndarray] | None = None) -> DataFrame:
    """doc_id and the compressed bytes of the text, to pass through shuffles; of the rows ``chosen``
    from a batch, if given."""
    def squeeze(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        pack = zstandard.ZstdCompressor(level=3)
        if chosen is not None:
            batches = (batch.filter(pa.array(chosen(batch))) for batch in batches)
        for ids, values in texts(batches, 1 << 20):
            yield pa.RecordBatch.from_arrays([pa.array(ids, pa.int64()),
                                              pa.array([pack.compress((v or "").encode()) for v in values], pa.binary())],
                                             ["doc_id", "raw"])

    return docs.mapInArrow(squeeze, "doc_id long, raw binary")


# -- hashes of 64 bits over numpy arrays -----------------------------------------------------

def mixed(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads their bits."""
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xFF51AFD7ED558CCD)
    h = h ^ (h >> np.uint64(33))
    h = h * np.uint64(0xC4CEB9FE1A85EC53)
    return h ^ (h >> np.uint64(33))


_BASE = 0x9E3779B97F4A7C15
_BACK = pow(_BASE, -1, 1 << 64)
_BYTE = mixed(np.arange(1, 257, dtype=np.uint64))
_POWERS: dict[int, np.ndarray] = {}


def powers(base: int, n: int) -> np.ndarray:
    """base ** 0 .. base ** (n - 1) modulo 2 ** 64; those of ordinary blocks are kept."""
    have = _POWERS.get(base)
    if have is None or len(have) < n:
        have = np.full(max(n, 1 << 16), base, np.uint64)
        have[0] = 1
        have = np.multiply.accumulate(have)
        if n <= BLOCK // 2:
            _POWERS[base] = have
    return have[:n]


class RollingHash:
    """64-bit hashes of any slices of one byte string, from prefix sums."""

    def __init__(self, data: np.ndarray):
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(_BYTE[data] * powers(_BASE, len(data)), out=self.sums[1:])
        self.down = powers(_BACK, len(data) + 1)

    def of(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        return mixed((self.sums[end] - self.sums[start]) * self.down[start])

    def windows(self, k: int) -> np.ndarray:
        """Of every slice of ``k`` bytes."""
        n = max(0, len(self.sums) - k)
        return mixed((self.sums[k:k + n] - self.sums[:n]) * self.down[:n])


def packed(*arrays: np.ndarray) -> bytes:
    """Arrays as one compressed byte string; the first of 64-bit numbers is sorted, kept as steps."""
    import zstandard
    first = arrays[0].astype(np.uint64)
    first[1:] -= first[:-1].copy()
    body = b"".join(planes(a) for a in (first, *arrays[1:]))
    head = struct.pack("<B", len(arrays)) + b"".join(
        struct.pack("<2sQ", a.dtype.str[1:].encode(), len(a)) for a in (first, *arrays[1:]))
    return head + zstandard.ZstdCompressor(level=1).compress(body)


def planes(a: np.ndarray) -> bytes:
    """Bytes of the same place together: the high ones are mostly zeros."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.dtype.itemsize).T.tobytes()


def unpacked(blob: bytes) -> list[np.ndarray]:
    import zstandard
    n, at, shapes, out = blob[0], 1, [], []
    for _ in range(n):
        kind, size = struct.unpack_from("<2sQ", blob, at)
        shapes.append((np.dtype("<" + kind.decode()), size))
        at += 10
    body, at = zstandard.ZstdDecompressor().decompress(
        blob[at:], max_output_size=sum(d.itemsize * s for d, s in shapes) or 1), 0
    for dtype, size in shapes:
        raw = np.frombuffer(body, np.uint8, dtype.itemsize * size, at).reshape(dtype.itemsize, size)
        out.append(np.ascontiguousarray(raw.T).reshape(-1).view(dtype))
        at += dtype.itemsize * size
    out[0] = np.cumsum(out[0], dtype=np.uint64)
    return out
