"""Labelled CSV files and folders."""

from __future__ import annotations

import logging
from collections.abc import Iterator
from multiprocessing.pool import ThreadPool

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from flowguard.functions.cleaning import clean_numeric
from flowguard.functions.labels import class_of_path, normalize_labels
from flowguard.operators.keys import ensure_flow_id, union_by_name
from flowguard.taxonomy import CLASS_RULES, TRAFFIC, Taxonomy

log = logging.getLogger(__name__)

BAD_LINE = "_bad_line"
HEADER_THREADS = 16


class SourceError(ValueError):
    """No usable input files."""


def _hadoop_path(spark: SparkSession, path: str):
    """The path and its file system, whichever store it is on."""
    hadoop_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path, hadoop_path.getFileSystem(spark._jsc.hadoopConfiguration())


def path_exists(spark: SparkSession, path: str) -> bool:
    hadoop_path, fs = _hadoop_path(spark, path)
    return fs.exists(hadoop_path)


def list_csv(spark: SparkSession, path: str) -> list[tuple[str, str]]:
    """(file, path below the folder) of every ``*.csv`` under a folder, in name order."""
    hadoop_path, fs = _hadoop_path(spark, path)
    if not fs.exists(hadoop_path):
        return []
    root = fs.resolvePath(hadoop_path).toString().rstrip("/") + "/"
    found, files = [], fs.listFiles(hadoop_path, True)
    while files.hasNext():
        name = files.next().getPath().toString()
        if name.endswith(".csv"):
            below = name[len(root):] if name.startswith(root) else name
            found.append((name, below))
    return sorted(found)


def _header_line(spark: SparkSession, file: str) -> str:
    hadoop_path, fs = _hadoop_path(spark, file)
    io = spark._jvm.java.io
    reader = io.BufferedReader(io.InputStreamReader(fs.open(hadoop_path), "UTF-8"))
    try:
        return (reader.readLine() or "").lstrip("﻿")
    finally:
        reader.close()


def read_headers(spark: SparkSession, files: list[str]) -> list[str]:
    """First line of each file; nothing else of it is read."""
    with ThreadPool(min(HEADER_THREADS, max(1, len(files)))) as pool:
        return pool.map(lambda f: _header_line(spark, f), files)


def header_columns(spark: SparkSession, header: str) -> list[str]:
    """Trimmed column names of a header line; repeats get ``.1``, ``.2`` and so on."""
    row = spark.range(1).select(F.from_csv(
        F.lit(header), ", ".join(f"c{i} string" for i in range(header.count(",") + 1)),
        {"escape": '"'}).alias("h")).first()["h"]
    names = [n.strip() if n else "" for n in row]
    while names and not names[-1]:
        names.pop()
    out, seen = [], {}
    for i, n in enumerate(names):
        n = n or f"Unnamed: {i}"
        seen[n] = seen.get(n, -1) + 1
        out.append(n if not seen[n] else f"{n}.{seen[n]}")
    return out


def _row_id(name: str) -> list[Column]:
    """An id from the file, the split's start and the row's place among the rows its task reads.
    A repeated task reads the same rows in the same order, so the ids come out again."""
    place = F.monotonically_increasing_id().bitwiseAND(F.lit((1 << 33) - 1))
    parts = F.md5("_metadata.file_path"), F.col("_metadata.file_block_start"), place
    return [F.concat_ws(":", *[p.cast("string") for p in parts]).alias(name)]


def _scan(spark: SparkSession, files: list[str], columns: list[str], row_id: str | None = None) -> DataFrame:
    """Files of one header as text columns, with an id per row if ``row_id`` names it. Short lines are padded with NULL, lines with too
    many fields are left out.

    Only malformed lines keep their raw text, so only those are counted. Column pruning is
    off for this scan: with it the parser would not see a line's full length.
    """
    schema = ", ".join(f"`c{i}` string" for i in range(len(columns))) + f", `{BAD_LINE}` string"
    raw = (spark.read.schema(schema).option("header", True).option("mode", "PERMISSIVE")
           .option("escape", '"').option("columnNameOfCorruptRecord", BAD_LINE)
           .option("columnPruning", False).option("enforceSchema", True).csv(files))
    # The empty piece of c0 makes every query read a data column: Spark refuses scans of the
    # raw-line column alone, such as a bare count.
    line = F.concat(BAD_LINE, F.substring(F.coalesce("c0", F.lit("")), 1, 0))
    unquoted = F.regexp_replace(line, r'"([^"]|"")*"', "")
    fields = F.size(F.split(unquoted, ","))
    kept = raw.where(F.col(BAD_LINE).isNull() | (fields <= len(columns)))
    meta = [*(_row_id(row_id) if row_id else []), F.col("_metadata.file_path").alias("_file"),
            F.col("_metadata.file_block_start").alias("_block")]
    return kept.select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(columns)], *meta)


def first_rows(df: DataFrame, n: int) -> DataFrame:
    """The first ``n`` rows of each file of a scan that has ``_file`` and ``_block``.

    Files are read in splits. One small table gives each split's row count and first row
    number; a row's place is its place in the split plus the counts of the splits before
    it. No file is sorted or gathered in one task.
    """
    numbered = df.withColumn("_row", F.monotonically_increasing_id())
    splits = numbered.groupBy("_file", "_block").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_row").alias("_first"))
    before = Window.partitionBy("_file").orderBy("_block").rowsBetween(Window.unboundedPreceding, -1)
    starts = splits.select("_file", "_block", "_first",
                           F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_offset"))
    place = F.col("_row") - F.col("_first") + F.col("_offset")
    kept = numbered.join(starts.where(F.col("_offset") < n), ["_file", "_block"]).where(place < n)
    return kept.select(*df.columns)


def scan_csv(spark: SparkSession, path: str, max_rows: int | None = None,
             keep_source: bool = False, row_id: str | None = None) -> DataFrame:
    """One CSV file (or files sharing a header) as text columns with trimmed names."""
    header = read_headers(spark, [path])[0]
    df = _scan(spark, [path], header_columns(spark, header), row_id)
    return _finish(df, max_rows, keep_source)


def _finish(df: DataFrame, max_rows: int | None, keep_source: bool) -> DataFrame:
    if max_rows is not None:
        df = first_rows(df, max_rows)
    return df if keep_source else df.drop("_file", "_block")


def _groups(spark: SparkSession, files: list[tuple[str, str]]) -> Iterator[tuple[list[str], str, list[str]]]:
    """Files of equal class and header, which one scan can read: Spark binds CSV columns by
    position, so files with another column order need a scan of their own."""
    headers = read_headers(spark, [f for f, _ in files])
    groups: dict[tuple[str, str], list[str]] = {}
    for (file, name), header in zip(files, headers):
        groups.setdefault((name, header), []).append(file)
    for (name, header), members in groups.items():
        yield members, name, header_columns(spark, header)


def scan_labelled_dir(spark: SparkSession, path: str, taxonomy: Taxonomy = TRAFFIC,
                      rules=CLASS_RULES, max_rows: int | None = None, legacy: bool = False,
                      with_key: bool = True, keep_source: bool = False, row_id: str | None = None) -> DataFrame:
    """All CSV files under a folder, labelled by their path.

    A file whose path names no class is left out. Columns are text and matched by name;
    ``attack_type`` and ``Label`` are added, ``flow_id`` unless ``with_key`` is off, and an id per
    row if ``row_id`` names one.
    """
    files = list_csv(spark, path)
    if not files:
        raise SourceError(f"no CSV files under {path}")
    named = [(f, class_of_path(below, rules, legacy)) for f, below in files]
    known = [(f, c) for f, c in named if c is not None]
    if not known:
        raise SourceError(f"no CSV file under {path} matches a class")
    if len(known) < len(named):
        log.warning("%s: skipped %d file(s) of no known class", path, len(named) - len(known))
    frames = []
    for members, name, columns in _groups(spark, known):
        df = _finish(_scan(spark, members, columns, row_id), max_rows, keep_source)
        frames.append(df.withColumn("attack_type", F.lit(name))
                        .withColumn("Label", F.lit(int(name != taxonomy.benign))))
    out = union_by_name(frames)
    return ensure_flow_id(out) if with_key else out


def load_source(spark: SparkSession, csv: str | None, folder: str | None,
                taxonomy: Taxonomy = TRAFFIC, **options) -> DataFrame | None:
    """A labelled table from a single CSV if there is one, else from a folder, else None."""
    if csv and path_exists(spark, csv):
        df = scan_csv(spark, csv, options.get("max_rows"), row_id=options.get("row_id"))
        return ensure_flow_id(normalize_labels(df, taxonomy, options.get("rules", CLASS_RULES)))
    if folder and list_csv(spark, folder):
        return scan_labelled_dir(spark, folder, taxonomy, **options)
    return None


def load_populations(spark: SparkSession, packet_csv: str | None, packet_dir: str | None,
                     flow_csv: str | None, flow_dir: str | None, taxonomy: Taxonomy = TRAFFIC,
                     row_id: str | None = "packet_id", **options) -> tuple[DataFrame, DataFrame]:
    """Packet and flow tables; both are needed. Packets get an id of their own."""
    packets = load_source(spark, packet_csv, packet_dir, taxonomy, row_id=row_id, **options)
    flows = load_source(spark, flow_csv, flow_dir, taxonomy, **options)
    if packets is None or flows is None:
        missing = [n for n, d in (("packet", packets), ("flow", flows)) if d is None]
        raise SourceError("no input for: " + ", ".join(missing))
    return packets, flows


def numeric_columns(df: DataFrame, share: float = 0.5, keep: tuple[str, ...] = ()) -> list[str]:
    """Text columns of which more than ``share`` reads as a number, from one aggregation."""
    names = [c for c, t in df.dtypes if t == "string" and c not in keep]
    if not names:
        return []
    row = df.agg(*[F.avg(F.col(f"`{c}`").try_cast("double").isNotNull().cast("double")).alias(f"s{i}")
                   for i, c in enumerate(names)]).first()
    return [c for i, c in enumerate(names) if (row[f"s{i}"] or 0.0) > share]


def typed(df: DataFrame, keep: tuple[str, ...] = ("flow_id", "src_ip", "dst_ip", "attack_type", "timestamp"),
          share: float = 0.5) -> DataFrame:
    """Turn text columns that hold numbers into doubles, with NaN and +-Inf as NULL."""
    return clean_numeric(df, numeric_columns(df, share, keep))
