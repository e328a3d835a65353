"""Token ids as flat files of unsigned integers with 64-bit document offsets.

A folder holds for each partition ``part-N.bin`` (ids one after another, 16 bits each if the
vocabulary allows, else 32) and ``part-N.idx`` (64-bit numbers: the count of documents n, n + 1
offsets into the ids of the whole folder, n document ids). Documents stand in ascending id order
over all parts. The parts are written in any order, each with its own counts; the bases of the
offsets are prefix sums over the totals of the parts, of which there are as many as partitions.
Readers map the files into memory and slice them.

A task writes to a name of its own and renames it, so a repeated task changes nothing. The
folder must be reachable from all executors as a file path or a URI that pyarrow can open; only
file paths are mapped into memory, other stores are read.

Defined results: a null or empty text gives the end id alone; repeated ids stand in the order of
their texts; a null id comes first and is kept as null; an empty table gives empty parts. Only
the id and text columns are read.
"""

from __future__ import annotations

import json
import os
from array import array
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain

import numpy as np
import pyarrow as pa
import regex
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession

from flowguard.llm.common import id_and_text, parts, texts

REMEMBERED = 400_000
NO_ID = np.iinfo(np.int64).min


#: Words that normalization only puts in lower case: no white space, nothing to compose.
SIMPLE = regex.compile("[!-~¡-ɏ]+")
# The characters that stand for bytes in byte-level vocabularies.
SHOWN = [*range(33, 127), *range(161, 173), *range(174, 256)]


def byte_characters() -> dict[int, str]:
    hidden = [b for b in range(256) if b not in SHOWN]
    return {b: chr(b) for b in SHOWN} | {b: chr(256 + i) for i, b in enumerate(hidden)}


class WordEncoder:
    """A tokenizer whose words end at white space, so each distinct word is encoded once. If the
    file has the parts of a lower-casing byte-level vocabulary, simple words are cut by its
    pattern and each distinct cut is given to the library's model alone; all other words, and
    those with a special token, go through the whole tokenizer."""

    def __init__(self, path: str, wide: bool):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer
        self.lib, self.code = Tokenizer.from_file(path), "I" if wide else "H"
        self.model, self.known, self.older = self.lib.model, {}, {}
        self.cuts: dict[str, bytes] = {}
        self.shown = [c for _, c in sorted(byte_characters().items())]
        parts = json.loads(self.lib.to_str())
        steps, cut = parts["normalizer"].get("normalizers", []), parts["pre_tokenizer"].get("pretokenizers", [])
        plain = ([n["type"] for n in steps] == ["NFC", "Replace", "Lowercase"] and [c["type"] for c in cut] == ["Split", "ByteLevel"]
                 and cut[0]["invert"] and cut[0]["behavior"] == "Removed" and not cut[1]["add_prefix_space"] and not cut[1]["use_regex"])
        self.cut = regex.compile(cut[0]["pattern"]["Regex"]) if plain else None
        self.special = regex.compile("|".join(regex.escape(t["content"]) for t in parts["added_tokens"]) or "(?!)")

    def cut_ids(self, text: str) -> bytes:
        found = self.cuts.get(text)
        if found is None:
            if len(self.cuts) > REMEMBERED:
                self.cuts.clear()
            shown = text if text.isascii() else "".join([self.shown[b] for b in text.encode()])
            found = self.cuts[text] = array(self.code, [t.id for t in self.model.tokenize(shown)]).tobytes()
        return found

    def learn(self, fresh: list[bytes]) -> None:
        rest, known, cut_ids = [], self.known, self.cut_ids
        if self.cut is None:
            rest, fresh = fresh, []
        for w in fresh:
            text = w.decode()
            if w.isalpha():  # ASCII letters are one cut
                known[w] = cut_ids(text.lower())
            elif SIMPLE.fullmatch(text) and not self.special.search(text):
                known[w] = b"".join([cut_ids(c) for c in self.cut.findall(text.lower())])
            else:
                rest.append(w)
        found = self.lib.encode_batch_fast([w.decode() for w in rest], add_special_tokens=False)
        known.update((w, array(self.code, e.ids).tobytes()) for w, e in zip(rest, found))

    def encode(self, values: list[str | None]) -> list[bytes]:
        split = [v.encode().split() if v else [] for v in values]
        every = set(chain.from_iterable(split))
        wanted = every.difference(self.known)
        if len(self.known) + len(wanted) > REMEMBERED:
            self.known, self.older, wanted = {}, self.known, every
        known, older = self.known, self.older
        known.update((w, older[w]) for w in wanted.intersection(older))
        self.learn([w for w in wanted if w not in known])
        return [b"".join([known[w] for w in words]) for words in split]


@lru_cache(maxsize=2)
def encoder(path: str, wide: bool) -> WordEncoder:
    return WordEncoder(path, wide)


@lru_cache(maxsize=8)
def is_wide(path: str) -> bool:
    from tokenizers import Tokenizer
    return Tokenizer.from_file(path).get_vocab_size() > 1 << 16


def place(folder: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(folder) if ":" in folder else (fs.LocalFileSystem(), folder)


def mapped(folder: str, name: str, dtype: str) -> np.ndarray:
    store, path = place(folder)
    if store.type_name != "local":
        with store.open_input_stream(f"{path}/{name}") as f:
            return np.frombuffer(f.read(), dtype)
    size = os.path.getsize(f"{path}/{name}")
    return np.memmap(f"{path}/{name}", dtype, "r") if size else np.zeros(0, dtype)


def renamed(store: fs.FileSystem, path: str, name: str, write) -> None:
    """``write(file)`` under a name of this task, then renamed."""
    own = f"{path}/{name}.{TaskContext.get().taskAttemptId()}.tmp"
    with store.open_output_stream(own) as f:
        write(f)
    store.move(own, f"{path}/{name}")


def write_tokens(docs: DataFrame, folder: str, path: str, end_id: int, id_col: str = "doc_id",
                 text_col: str = "text") -> None:
    """Encode every document with the tokenizer at ``path`` and write the folder."""
    spark, wide = docs.sparkSession, is_wide(path)
    store, root = place(folder)
    store.create_dir(root, recursive=True)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, book = TaskContext.get().partitionId(), encoder(path, wide)
        end, width = np.asarray([end_id], book.code).tobytes(), 4 if wide else 2
        keys, sizes = array("q"), array("q")

        def body(f) -> None:
            for ids, values in texts(batches, 2 << 20):
                for key, found in zip(ids, book.encode(values)):
                    f.write(found + end)
                    keys.append(NO_ID if key is None else key)
                    sizes.append(len(found) // width + 1)

        store, root = place(folder)
        renamed(store, root, f"part-{part:06d}.bin", body)
        numbers = np.concatenate([[len(keys)], np.cumsum([0, *sizes]), np.asarray(keys, np.int64)]).astype("<i8")
        renamed(store, root, f"part-{part:06d}.own", lambda f: f.write(numbers.tobytes()))
        yield pa.RecordBatch.from_arrays([pa.array([part], pa.int32()), pa.array([sum(sizes)], pa.int64())], ["part", "n"])

    ordered = id_and_text(docs, id_col, text_col).repartitionByRange(parts(spark), "doc_id") \
                                                 .sortWithinPartitions("doc_id", "text")
    totals = dict((r.part, r.n) for r in ordered.mapInArrow(write, "part int, n long").collect())
    count = max(totals, default=-1) + 1
    bases = np.cumsum([0, *(totals.get(p, 0) for p in range(count))]).tolist()

    def place_index(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, root = place(folder)
        for batch in batches:
            for part in batch.column("id").to_pylist():
                if part not in totals:
                    continue
                numbers = np.array(mapped(folder, f"part-{part:06d}.own", "<i8"))
                numbers[1:numbers[0] + 2] += bases[part]
                renamed(store, root, f"part-{part:06d}.idx", lambda f, x=numbers: f.write(x.tobytes()))
            yield batch

    spark.range(0, count, 1, max(1, count)).mapInArrow(place_index, "id long").count()
    with store.open_output_stream(f"{root}/parts.txt") as f:
        f.write(f"{'<u4' if wide else '<u2'} {' '.join(str(p) for p in sorted(totals))}".encode())


def read_tokens(spark: SparkSession, folder: str) -> DataFrame:
    """doc_id, start (ids before the document in the folder) and ids (32-bit, little-endian)."""
    store, root = place(folder)
    with store.open_input_stream(f"{root}/parts.txt") as f:
        dtype, *names = f.read().decode().split()
    listed = [int(n) for n in names]

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for place_no in batch.column("id").to_pylist():
                part = listed[place_no]
                index = mapped(folder, f"part-{part:06d}.idx", "<i8")
                ids, n = mapped(folder, f"part-{part:06d}.bin", dtype), int(index[0])
                ends, keys = index[1:n + 2], index[n + 2:]
                begin = 0
                while begin < n:  # about a million ids at a time, one document at least
                    stop = max(begin + 1, int(np.searchsorted(ends, ends[begin] + (1 << 20), "right")) - 1)
                    cut = ends[begin:stop + 1] - ends[begin]
                    body = np.ascontiguousarray(ids[ends[begin] - ends[0]:ends[stop] - ends[0]]).astype("<u4")
                    data = pa.Array.from_buffers(pa.large_binary(), stop - begin, [
                        None, pa.py_buffer((cut * 4).astype("<i8").tobytes()), pa.py_buffer(body.tobytes())])
                    own = keys[begin:stop]
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(own, pa.int64(), mask=np.asarray(own == NO_ID)), pa.array(ends[begin:stop], pa.int64()),
                         data.cast(pa.binary())], ["doc_id", "start", "ids"])
                    begin = stop

    return spark.range(0, len(listed), 1, max(1, len(listed))).mapInArrow(read, "doc_id long, start long, ids binary")
