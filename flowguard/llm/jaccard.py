"""Self join of documents on the Jaccard similarity of their word n-grams, with a count-vector
R-tree.

A document's set holds the 64-bit hashes of its distinct 5-word shingles. Documents of one set
form a class, found by a fingerprint; from then on a class is one point.

*Where trees are needed.* Two sets of sizes a and b with similarity 0.8 or more differ in at most
(a + b) / 9 shingles. Hashing the shingles into more groups than that leaves a group without a
difference, so linked sets share the content of a group. Each set deals the hashes of its group
contents (per class of sizes, packed and sorted, a few bytes each) to buckets; sets that meet
there form clusters by connected components. Shingles common in a sample are left out of the groups, which
keeps the guarantee; a set with too few filled groups for it deals all its shingles' groups, and
if need be its single shingles, as well. Every link lies inside a cluster.

*Who can be linked.* A link spoils at most as many groups as its sets differ in, so a linked set
shares all others of its filled groups. A set that shares fewer than that with all sets together (a passage
quoted here and there) has no link: it is left out, and joins no clusters but as the hub of those
that met at it.

*The tree.* A point is the vector of shingle counts by hash group (64 groups, more for larger
sets; vectors of different lengths are folded). The points of a cluster, ordered by size and
first coordinates, are packed into leaves and those into nodes; a box keeps the sizes and the
greatest counts below it. The summed minima of a query's counts and a box's counts bound the
overlap with anything in the box, so a query descends only into boxes that can reach the overlap
its threshold needs; surviving pairs are verified on the sets.

*Large clusters.* Only components matter, so the cluster's most central point (by shared groups)
is compared with all others first, one pair each, under the same bound; what it links is settled,
and only the remaining points query the tree. Work on a group of copies is linear in it, no
pairs of a group are enumerated, and nothing is capped.

*Links.* The number of links of a component counts every linked pair of documents, equal sets
included. The points of a cluster, ordered by size, are cut into blocks; every two blocks whose sizes
allow a link meet in a task that counts the shingles their sets share. No pair is emitted, only a
sum for each point, weighted by the copies on both sides; pairs of copies are counted by formula.
The comparisons of a cluster grow with the square of its different sets, the rows with that over BESIDE.

Defined results: a null or empty text or one without words has no shingles and links with
nothing; fewer words than five are one shingle; ties do not arise, as components are named by
their least id; repeated rows belong to one class; a null id is linked with nothing and has a
null component; an empty table gives an empty table. Only the id and text columns are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from flowguard.llm.bytebpe import with_constants
from flowguard.llm.common import (LOWER, RollingHash, bounded_batches, id_and_text, joined, mixed, packed, parts, quoted, scratch, squeezed, stage,
                                  texts, unpacked, unused)
from flowguard.llm.graph import components

SHINGLE = 5
#: Points of a leaf and leaves of a node.
LEAF = 64
FAN = 32
#: Group contents that one bucket is meant to hold, and that a task packs at once.
BUCKET = 1 << 19
#: Characters of text hashed at once: a worker holds some fifty bytes for each.
BLOCK = 1 << 18
#: Bytes of an Arrow batch, which the executor and its worker both hold.
BATCH_BYTES = 2 << 20

#: Points and shingles of a block whose links are counted at once.
BESIDE = 1024
BESIDE_SHINGLES = 1 << 19

POINT = "cluster long, doc_id long, n long, raw binary, counts binary, c0 int, c1 int, fa long, fb long, copies long"
U = np.uint64


def shingle_sets(values: list[str | None]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of each text, one text after another, and their numbers."""
    data, bounds = joined(values, LOWER)
    data = np.where((data >= 9) & (data <= 13), np.uint8(32), data)
    starts, ends = word_bounds_of(data)
    words = RollingHash(data).of(starts, ends)
    counts = np.diff(np.searchsorted(starts, bounds))
    own = np.repeat(np.arange(len(values)), counts)
    found, owner = np.zeros(0, U), np.zeros(0, np.int64)
    if len(words) >= SHINGLE:
        h = words[:len(words) - SHINGLE + 1].copy()
        for k in range(1, SHINGLE):
            h = mixed(h * U(0x9E3779B97F4A7C15) + words[k:len(words) - SHINGLE + 1 + k])
        whole = own[:len(h)] == own[SHINGLE - 1:]
        found, owner = h[whole], own[:len(h)][whole]
    short = np.flatnonzero((counts > 0) & (counts < SHINGLE))
    if len(short):
        first = np.cumsum(counts) - counts
        h = mixed(words[first[short]] + U(1))
        for k in range(1, SHINGLE - 1):
            more = counts[short] > k
            at = np.minimum(first[short] + k, len(words) - 1)
            h = np.where(more, mixed(h * U(0x9E3779B97F4A7C15) + words[at] + U(k)), h)
        found, owner = np.concatenate([found, h]), np.concatenate([owner, short])
    order = np.lexsort((found, owner))
    found, owner = found[order], owner[order]
    new = np.append(True, (found[1:] != found[:-1]) | (owner[1:] != owner[:-1])) if len(found) else np.zeros(0, bool)
    return found[new], np.bincount(owner[new], minlength=len(values))


def word_bounds_of(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    inside = np.zeros(len(data) + 2, np.int8)
    inside[1:-1] = data != 32
    steps = np.diff(inside)
    return np.flatnonzero(steps == 1), np.flatnonzero(steps == -1)


def sums(values: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """Sums modulo 2 ** 64 of consecutive runs."""
    total = np.concatenate([np.zeros(1, U), np.cumsum(values, dtype=U)])
    ends = np.cumsum(counts)
    return total[ends] - total[ends - counts]


def fingerprints(found: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    return mixed(sums(mixed(found), counts) + counts.astype(U)), mixed(sums(mixed(found ^ U(0x5851F42D4C957F2D)), counts))


def linked(shared: int, a: int, b: int) -> bool:
    return 100 * shared >= 80 * (a + b - shared)


# -- clusters --------------------------------------------------------------------------------

def size_classes(top: int) -> np.ndarray:
    """Upper ends of the classes of set sizes, up to one beyond ``top``."""
    ends = [3]
    while ends[-1] <= top:
        ends.append(max(ends[-1] + 2, ends[-1] * 3 // 2))
    return np.asarray([*ends, max(ends[-1] + 2, ends[-1] * 3 // 2)])


def dealt_groups(h: np.ndarray, n: np.ndarray, kind: np.ndarray, groups: np.ndarray, salt: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the filled groups of sets (``n`` shingles each, one set after another), the place
    of their set, and the number of filled groups of each set."""
    spread = mixed(h ^ mixed(U(977 + salt) + kind.astype(U)).repeat(n))
    base = np.cumsum(groups) - groups
    cell = np.repeat(base, n) + ((spread >> U(20)) % np.repeat(groups, n).astype(U)).astype(np.int64)
    order = np.argsort(cell, kind="stable")
    cell = cell[order]
    new = np.flatnonzero(np.append(True, cell[1:] != cell[:-1])) if len(cell) else np.zeros(0, np.int64)
    sizes = np.diff(np.append(new, len(cell)))
    filled = cell[new]
    place = np.searchsorted(np.cumsum(groups), filled, "right")
    inner = (filled - base[place]).astype(U)
    keys = mixed(sums(spread[order], sizes) + mixed(inner + (kind[place].astype(U) << U(40)) + (sizes.astype(U) << U(50)) + U(salt)))
    return keys, place, np.bincount(place, minlength=len(n))


#: Kinds of group contents of a set: of rare shingles in its own class of sizes and in the next, all others.
OWN, NEXT, OTHER = 0, 1, 2
#: More than any set can share.
NEVER = (1 << 31) - 1


def contents(found: np.ndarray, counts: np.ndarray, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of the group contents of each set and the place of the set they belong to."""
    return group_contents(found, counts, common)[:2]


def group_contents(found: np.ndarray, counts: np.ndarray, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Hashes of the group contents of each set, the place of the set they belong to, their kind
    (``OWN``, ``NEXT`` or ``OTHER``), and for each set how many of the kinds ``OWN`` and ``NEXT`` a
    linked set shares at least: in one of the two it does.

    Groups are made of the shingles that are not in ``common``: two sets differ there in no more
    shingles than in all, and texts that share a well-known passage do not meet for it. A set
    with too few filled groups deals the groups of all its shingles as well, and if those are
    still too few, its single shingles; two such sets meet there.
    """
    ends = size_classes(int(counts.max(initial=0)))
    own = np.searchsorted(ends, counts)
    able = counts > 3  # smaller sets link with equal sets alone
    upper = able & (counts * 5 // 4 > ends[own])  # a partner may lie in the next class
    rare = np.ones(len(found), bool) if common is None or not len(common) else ~np.isin(found, common)
    keys, sets, slots = [], [], []
    needs = np.full((2, len(counts)), NEVER, np.int64)
    first = np.cumsum(counts) - counts
    for slot, chosen, kind in ((OWN, np.flatnonzero(able), own), (NEXT, np.flatnonzero(upper), own + 1)):
        if not len(chosen):
            continue
        n, k = counts[chosen], kind[chosen]
        differ = ends[k] * 2 // 9
        groups = differ + differ // 24 + 3
        most = (n + np.minimum(n * 5 // 4, ends[k])) // 9  # shingles in which a linked set may differ
        at = np.repeat(first[chosen] - (np.cumsum(n) - n), n) + np.arange(n.sum())
        inside = rare[at]
        holder = np.repeat(np.arange(len(chosen)), n)
        made, place, filled = dealt_groups(found[at][inside], np.bincount(holder[inside], minlength=len(chosen)), k, groups, 0)
        keys.append(made)
        sets.append(chosen[place])
        slots.append(np.full(len(made), slot))
        needs[slot, chosen] = np.maximum(0, filled - most)
        poor = np.flatnonzero(filled <= most)
        if len(poor):
            h = found[at][np.isin(holder, poor)]
            made, place, filled = dealt_groups(h, n[poor], k[poor], groups[poor], 1)
            keys.append(made)
            sets.append(chosen[poor][place])
            bare = np.flatnonzero(filled <= most[poor])
            take = np.isin(np.repeat(np.arange(len(poor)), n[poor]), bare)
            keys.append(mixed(h[take] ^ mixed(np.repeat(k[poor], n[poor])[take].astype(U) + U(2))))
            sets.append(np.repeat(chosen[poor], n[poor])[take])
            slots += [np.full(len(made), OTHER), np.full(len(keys[-1]), OTHER)]
    if not keys:
        return np.zeros(0, U), np.zeros(0, np.int64), np.zeros(0, np.int64), needs
    return np.concatenate(keys), np.concatenate(sets), np.concatenate(slots), needs


#: Rows of the sample that tells common shingles, sets of it that make one common, and most of them.
#: Any choice gives the same links; a good one keeps unlike texts apart.
COMMON_ROWS = 4_000
COMMON_SETS = 4
COMMON = 200_000


def common_shingles(docs: DataFrame, rows: int) -> np.ndarray:
    """Sorted hashes of shingles in several different sets of a sample drawn by hash of the id."""
    def shingles(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, values in texts(batches, BLOCK):
            found, counts = shingle_sets(values)
            mark = np.repeat(fingerprints(found, counts)[0], counts)
            yield pa.RecordBatch.from_arrays([pa.array(found.view(np.int64)), pa.array(mark.view(np.int64))], ["h", "mark"])

    place = F.pmod(F.xxhash64("doc_id", F.lit("common")), F.lit(1 << 30)) / (1 << 30)
    met_in = docs.filter(place < COMMON_ROWS / max(1, rows)).mapInArrow(shingles, "h long, mark long").distinct()
    top = met_in.groupBy("h").count().filter(F.col("count") >= COMMON_SETS).orderBy(F.desc("count"), "h").limit(COMMON)
    return np.sort(np.asarray([r["h"] for r in top.collect()], np.int64).view(U))


def candidate_edges(docs: DataFrame, total: int, drop: int, common: np.ndarray) -> DataFrame:
    """Edges (a, b) between set marks that share a group content, with weight 0, and rows (a, a)
    whose weight counts the sharings of a; ``own`` and ``next`` count its shared contents of these
    kinds, ``need_own`` and ``need_next`` how many a link takes. A mark is a fingerprint without its low ``drop``
    bits; of the content hashes, too, only as many bits are sent as keep chance meetings rare. Sets
    that meet by chance cost a comparison, no more."""
    bits = max(4, int(total // 2 // BUCKET).bit_length())
    shared = docs.sparkSession.sparkContext.broadcast(common)
    spare = max(0, 64 - int(max(total, 2)).bit_length() - 20)

    def deal(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []
        wants: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size, seen = 0, np.zeros(0, U)

        def flush() -> pa.RecordBatch:
            key, tag = (np.concatenate(x) for x in zip(*held))
            mark, own, next_ = (np.concatenate(x) for x in zip(*wants))
            held.clear()
            wants.clear()
            order = np.argsort(key)
            key, tag = key[order], tag[order]
            bucket = (key >> U(64 - bits)).astype(np.int64)
            cut = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1]))
            key >>= U(spare)
            blobs = [packed(key[a:b], tag[a:b]) for a, b in zip(cut, np.append(cut[1:], len(key)))]
            # Needs go to a bucket beyond those of the contents, any one.
            order = np.argsort(mark)
            blobs.append(packed(mark[order], own[order].astype(np.uint32), next_[order].astype(np.uint32)))
            where = np.append(bucket[cut], (1 << bits) + int(mark[0]) % (1 << bits))
            return pa.RecordBatch.from_arrays([pa.array(where, pa.int64()), pa.array(blobs, pa.binary())], ["bucket", "blob"])

        for _, values in texts(batches, BLOCK):
            found, counts = shingle_sets(values)
            mark = fingerprints(found, counts)[0] >> U(drop)
            key, place, slot, needs = group_contents(found, counts, shared.value)
            # Copies met again in this task deal nothing new: what a hot group sends is one set per task.
            fresh = np.zeros(len(mark), bool)
            fresh[np.unique(mark, return_index=True)[1]] = True
            fresh &= ~np.isin(mark, seen)
            seen = np.union1d(seen, mark)
            keep = fresh[place]
            if keep.any():
                held.append((key[keep], mark[place[keep]] << U(2) | slot[keep].astype(U)))
                dealing = np.unique(place[keep])
                wants.append((mark[dealing], *needs[:, dealing]))
                size += int(keep.sum())
            if size >= BUCKET:
                yield flush()
                size = 0
        if held:
            yield flush()

    def meet(table: pa.Table) -> pa.Table:
        blobs = [unpacked(b) for b in table.column("blob").to_pylist()]
        if table.column("bucket")[0].as_py() >= 1 << bits:
            mark, *needs = (np.concatenate(x).astype(np.int64) for x in zip(*blobs))
            none = np.zeros(len(mark), np.int64)
            return pa.table(dict(zip(MET, map(pa.array, (mark, mark, none, none, none, *needs)))))
        key, tag = (np.concatenate(x) for x in zip(*blobs))
        order = np.lexsort((tag, key))
        key, tag = key[order], tag[order]
        new = np.append(True, (key[1:] != key[:-1]) | (tag[1:] != tag[:-1]))
        key, mark, slot = key[new], tag[new] >> U(2), tag[new] & U(3)
        head = np.flatnonzero(np.append(True, key[1:] != key[:-1]))
        run = np.diff(np.append(head, len(key)))
        shared = np.repeat(run > 1, run)
        lead, others, weight = np.repeat(mark[head], run)[shared], mark[shared], np.repeat(run - 1, run)[shared]
        star = lead != others
        pairs = np.unique(np.stack([lead[star], others[star]], 1), axis=0)
        names, inverse = np.unique(others, return_inverse=True)
        sums_of = [np.bincount(inverse, x, len(names)) for x in (weight, slot[shared] == OWN, slot[shared] == NEXT)]
        both = [np.concatenate([pairs[:, i], names]).view(np.int64) for i in (0, 1)]
        counted = [np.concatenate([np.zeros(len(pairs)), x]).astype(np.int64) for x in sums_of]
        return pa.table(dict(zip(MET, [*map(pa.array, (*both, *counted)), *[pa.nulls(len(both[0]), pa.int64())] * 2])))

    dealt = docs.mapInArrow(deal, "bucket long, blob binary")
    return dealt.groupBy("bucket").applyInArrow(meet, ", ".join(f"{c} long" for c in MET))


MET = ["a", "b", "w", "own", "next", "need_own", "need_next"]


def meetings(edges: DataFrame) -> DataFrame:
    """One row per edge (a, b) and per mark (a, a) that shares a content: its weight, and whether
    it may have a link. Of two sets of one mark the lesser need holds."""
    able = (F.sum("own") >= F.coalesce(F.min("need_own"), F.lit(0))) | (F.sum("next") >= F.coalesce(F.min("need_next"), F.lit(0)))
    return edges.groupBy("a", "b").agg(F.sum("w").alias("w"), able.alias("able")).filter("a <> b OR w > 0")


def able_edges(found: DataFrame) -> DataFrame:
    """Edges between the marks that may have a link. Those that met at another mark are tied to
    the least of them."""
    able = found.filter("a = b AND able").select("a")
    ends = found.filter("a <> b").select("a", "b").join(able.withColumnRenamed("a", "b"), "b", "left_semi")
    hubs = ends.join(able, "a", "left_anti")
    least = hubs.groupBy("a").agg(F.min("b").alias("m"))
    return ends.join(able, "a", "left_semi").unionByName(hubs.join(least, "a").filter("b <> m").select(F.col("m").alias("a"), "b"))


# -- points and trees ------------------------------------------------------------------------

def groups_for(n: int) -> int:
    """Hash groups of a set: so many that chance meetings hardly loosen the bound."""
    return max(64, 1 << max(0, 2 * n - 1).bit_length())


def counts_of(shingles: np.ndarray) -> np.ndarray:
    g = groups_for(len(shingles))
    return np.bincount((mixed(shingles ^ U(31)) & U(g - 1)).astype(np.int64), minlength=g)


def folded(counts: np.ndarray, g: int) -> np.ndarray:
    return counts.reshape(-1, g).sum(axis=0)


def summed_minima(a: np.ndarray, b: np.ndarray) -> int:
    """Bound on the overlap of two sets, or of a set and a box."""
    g = min(len(a), len(b))
    return int(np.minimum(folded(a, g), folded(b, g)).sum())


def needed(n: int, low: int, high: int) -> int | None:
    """Least overlap that links a set of n with one of low to high; none if sizes rule it out."""
    low, high = max(low, -(-4 * n // 5)), min(high, 5 * n // 4)
    return None if low > high else -(-4 * (n + low) // 9)


def vector_blob(counts: np.ndarray) -> bytes:
    """A vector for a shuffle: the bytes of a count that are in use, then compressed."""
    import zstandard
    width = 1 if counts.max(initial=0) < 256 else 4
    return bytes((width,)) + zstandard.ZstdCompressor(level=1).compress(counts.astype(f"<u{width}").tobytes())


def vector(blob: bytes) -> np.ndarray:
    import zstandard
    return np.frombuffer(zstandard.ZstdDecompressor().decompress(blob[1:]), f"<u{blob[0]}").astype(np.int32)


def opened(batch: pa.RecordBatch, column: str) -> Iterator[tuple[pa.RecordBatch, list[str]]]:
    """Parts of a batch with their decompressed texts, about BLOCK characters at a time."""
    import zstandard
    open_, begin, held, size = zstandard.ZstdDecompressor(), 0, [], 0
    for i in range(batch.num_rows):
        held.append(open_.decompress(batch.column(column)[i].as_py()).decode())
        size += len(held[-1])
        if size > BLOCK or i == batch.num_rows - 1:
            yield batch.slice(begin, len(held)), held
            begin, held, size = i + 1, [], 0


#: Most bits of the filter of ids in front of the shuffle of texts.
FILTER_BITS = 1 << 23


def id_filter(ids: DataFrame) -> np.ndarray:
    """Bits, 64 in a number, on which the hashes of the ``doc_id`` of the rows fall; of bounded size."""
    bits = min(FILTER_BITS, 1 << max(10, (16 * ids.count()).bit_length()))
    words = ids.select(spot(bits).alias("spot")).groupBy(F.expr("spot DIV 64").alias("word")).agg(
        F.expr("bit_or(shiftleft(1L, int(spot % 64)))").alias("held"))
    have = np.zeros(bits // 64, np.int64)
    for word, held in words.collect():  # bits / 64 rows at most
        have[word] = held
    return have


def spot(bits: int) -> Column:
    return F.pmod(F.xxhash64("doc_id"), F.lit(bits))


def chosen_texts(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """doc_id and compressed text of the documents of ``nodes``, and of few others: those whose id
    falls on a bit of one of them. Only they are shuffled."""
    have = id_filter(nodes)
    marks = docs.sparkSession.sparkContext.broadcast(np.unpackbits(have.view(np.uint8), bitorder="little").astype(bool))
    return squeezed(docs.withColumn("spot", spot(64 * len(have))), lambda batch: marks.value[np.asarray(batch.column("spot"))])


def without(docs: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows of ``docs`` whose ``doc_id`` is not in ``ids``. Only those on a bit of the filter
    of ``ids`` go through a join."""
    have = id_filter(ids)
    hit, = unused(docs.columns, "hit")
    bit = lambda word, at: F.expr(f"shiftright({word}, int({at})) & 1") == 1
    named = with_constants(docs.withColumn(f"{hit}_at", spot(64 * len(have))), **{hit: pa.array(have)})
    marked = named.select(*(F.col(quoted(c)) for c in docs.columns), bit(f"get({hit}, int({hit}_at DIV 64))", f"{hit}_at % 64").alias(hit))
    some = marked.filter(hit).join(ids.select("doc_id"), "doc_id", "left_anti")
    return marked.filter(~F.col(hit)).unionByName(some).select(*(quoted(c) for c in docs.columns))


def points(docs: DataFrame, nodes: DataFrame) -> DataFrame:
    """The texts (compressed, smaller than their sets) and vectors of the representatives of the
    classes in clusters."""
    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for some, values in opened(batch, "raw"):
                rows = some.to_pylist()
                found, counts = shingle_sets(values)
                first, second = fingerprints(found, counts)
                ends = np.cumsum(counts)
                vectors = [counts_of(found[e - n:e]) for n, e in zip(counts.tolist(), ends.tolist())]
                coarse = [folded(v, 64) for v in vectors]
                out = [(r["cluster"], r["doc_id"], n, r["raw"], vector_blob(v), int(c[0]), int(c[1]), f, s, r["copies"])
                       for v, c, r, n, _, f, s in zip(vectors, coarse, rows, counts.tolist(), ends.tolist(),
                                                      first.view(np.int64).tolist(), second.view(np.int64).tolist())
                       if f == r["fa"] and s == r["fb"]]  # another text of the same id is another class
                yield pa.RecordBatch.from_arrays([pa.array([o[i] for o in out], kind) for i, kind in enumerate(
                    (pa.int64(), pa.int64(), pa.int64(), pa.binary(), pa.binary(), pa.int32(), pa.int32(), *[pa.int64()] * 3))],
                    ["cluster", "doc_id", "n", "raw", "counts", "c0", "c1", "fa", "fb", "copies"])

    rows = chosen_texts(docs, nodes).join(nodes.select("cluster", "doc_id", "fa", "fb", "copies"), "doc_id")
    return rows.select("cluster", "doc_id", "fa", "fb", "copies", "raw").mapInArrow(build, POINT)


def verified(pairs: DataFrame) -> DataFrame:
    """Of rows (a, b, na, nb, ca, cb, ra, rb) the links: bound first, then the sets."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import zstandard
        open_ = zstandard.ZstdDecompressor()
        for batch in batches:
            a, b, na, nb, ca, cb = (batch.column(c).to_pylist() for c in ("a", "b", "na", "nb", "ca", "cb"))
            near = [i for i in range(len(a)) if (need := needed(na[i], nb[i], nb[i])) is not None
                    and summed_minima(vector(ca[i]), vector(cb[i])) >= need]
            links, held, texts_held, size = [], [], {}, 0
            for k, i in enumerate(near):
                for name, column in ((a[i], "ra"), (b[i], "rb")):
                    if name not in texts_held:
                        texts_held[name] = open_.decompress(batch.column(column)[i].as_py()).decode()
                        size += len(texts_held[name])
                held.append(i)
                if size > BLOCK or k == len(near) - 1:
                    place = {name: j for j, name in enumerate(texts_held)}
                    found, counts = shingle_sets(list(texts_held.values()))
                    ends = np.cumsum(counts)
                    sets = [found[e - n:e] for n, e in zip(counts.tolist(), ends.tolist())]
                    links += [(a[i], b[i]) for i in held if linked(
                        len(np.intersect1d(sets[place[a[i]]], sets[place[b[i]]], assume_unique=True)), na[i], nb[i])]
                    held, texts_held, size = [], {}, 0
            yield pa.RecordBatch.from_arrays([pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], ["a", "b"])

    return pairs.mapInArrow(check, "a long, b long")


def beside(p: DataFrame, side: str) -> DataFrame:
    return p.select(F.col("doc_id").alias(side), F.col("n").alias(f"n{side}"), F.col("counts").alias(f"c{side}"),
                    F.col("raw").alias(f"r{side}"))


def pivot_links(p: DataFrame, pivots: DataFrame) -> DataFrame:
    """Links between the pivot of each cluster and its other points. A cluster's points are
    spread over salts, the pivot is repeated once for each."""
    salts = F.greatest(F.lit(1), F.col("size") / 256).cast("int")
    centre = p.join(pivots.withColumnRenamed("pivot", "doc_id"), ["cluster", "doc_id"]) \
              .select("cluster", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"),
                      F.col("doc_id").alias("a"), F.col("n").alias("na"), F.col("counts").alias("ca"), F.col("raw").alias("ra"))
    others = p.join(pivots, "cluster").filter("doc_id <> pivot").select(
        "cluster", F.pmod(F.xxhash64("doc_id"), salts).cast("int").alias("salt"),
        F.col("doc_id").alias("b"), F.col("n").alias("nb"), F.col("counts").alias("cb"), F.col("raw").alias("rb"))
    return verified(others.join(centre, ["cluster", "salt"]))


BOX = "cluster long, box string, parent string, low long, high long, top binary"


def packed_leaves(p: DataFrame) -> DataFrame:
    """The points with a leaf each: runs of at most LEAF of a cluster, in order of size and first
    coordinates, and each run of FAN leaves under one node."""
    kept = ["cluster", "doc_id", "n", "counts", "query", "size"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, leaf, node, inside, leaves, last = TaskContext.get().partitionId(), -1, -1, 0, 0, object()
        for batch in batches:
            names, above = [], []
            for cluster in batch.column("cluster").to_pylist():
                if cluster != last or inside == LEAF:
                    leaf, inside = leaf + 1, 0
                    if cluster != last or leaves == FAN:
                        node, leaves = node + 1, 0
                    leaves, last = leaves + 1, cluster
                inside += 1
                names.append(f"{part}-{leaf}")
                above.append(f"{part}-{node}")
            columns = [batch.column(c) for c in kept]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(names), pa.array(above)], [*kept, "leaf", "node"])

    order = ("cluster", "n", "c0", "c1", "doc_id")
    ordered = p.repartitionByRange(parts(p.sparkSession), *order).sortWithinPartitions(*order)
    return ordered.mapInArrow(assign, "cluster long, doc_id long, n long, counts binary, query boolean, size long, leaf string, node string")


def boxes(rows: DataFrame, box: str, parent: str) -> DataFrame:
    """Boxes over rows (cluster, low, high, top, and the names of box and parent)."""
    def enclose(table: pa.Table) -> pa.Table:
        tops = [vector(b) for b in table.column("top").to_pylist()]
        g = min(map(len, tops))
        top = np.max([folded(t, g) for t in tops], axis=0)
        first = table.slice(0, 1).to_pylist()[0]
        return pa.table({"cluster": pa.array([first["cluster"]], pa.int64()), "box": [first[box]], "parent": [first[parent]],
                         "low": pa.array([min(table.column("low").to_pylist())], pa.int64()),
                         "high": pa.array([max(table.column("high").to_pylist())], pa.int64()),
                         "top": pa.array([vector_blob(top)], pa.binary())})

    return rows.groupBy(box).applyInArrow(enclose, BOX)


def pruned(pairs: DataFrame, key: str) -> DataFrame:
    """Of rows (a, n, counts, low, high, top, key) those whose box can hold a partner of a."""
    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for i, (n, low, high, counts, top) in enumerate(zip(
                    *(batch.column(c).to_pylist() for c in ("n", "low", "high", "counts", "top")))):
                need = needed(n, low, high)
                if need is not None and summed_minima(vector(counts), vector(top)) >= need:
                    keep.append(i)
            yield pa.RecordBatch.from_arrays([batch.column(c).take(pa.array(keep, pa.int64())) for c in ("a", "n", "counts", "size", key)],
                                             ["a", "n", "counts", "size", key])

    return pairs.select("a", "n", "counts", "size", "low", "high", "top", key) \
                .mapInArrow(check, f"a long, n long, counts binary, size long, {key} string")


#: Queries of one leaf that a task compares at once, at least on average.
ASKED = 4096


def met(asks: pa.Table, entries: pa.Table) -> pa.Table:
    """Pairs of queries and points of one leaf whose counts allow a link, with the bound."""
    mine, theirs = (t.column("counts") for t in (asks, entries))
    out: list[list[np.ndarray]] = [[], [], [], []]
    if len(mine) and len(theirs):
        a, na = (np.asarray(asks.column(c).to_pylist(), np.int64) for c in ("a", "n"))
        b, nb = (np.asarray(entries.column(c).to_pylist(), np.int64) for c in ("doc_id", "n"))
        asking = np.asarray(entries.column("query").to_pylist(), bool)
        g = groups_for(int(min(na.min(), nb.min())))
        e = np.stack([folded(vector(v.as_py()), g) for v in theirs])
        step = max(1, (1 << 21) // e.size)
        for begin in range(0, len(a), step):
            x = np.stack([folded(vector(v.as_py()), g) for v in mine[begin:begin + step]])
            own, n = a[begin:begin + step, None], na[begin:begin + step, None]
            bound = np.minimum(x[:, None, :], e[None]).sum(axis=2)
            ok = (bound >= -(-4 * (n + nb) // 9)) & (5 * nb >= 4 * n) & (5 * n >= 4 * nb) & (own != b) & (~asking | (own < b))
            i, j = np.nonzero(ok)
            for column, values in zip(out, (own[i, 0], b[j], bound[i, j], asking[j])):
                column.append(values)
    made = [np.concatenate(v) if v else np.zeros(0) for v in out]
    return pa.table({k: pa.array(v.astype(kind)) for k, v, kind in zip(("a", "b", "bound", "open"), made, (np.int64,) * 3 + (bool,))})


def tree_pairs(p: DataFrame) -> DataFrame:
    """Pairs (a, b) of points that survive the descent, with their bound and whether b asks as
    well; ``query`` marks the points that ask."""
    leaves = stage(packed_leaves(p), "leaves")
    entries = leaves.select("cluster", "leaf", "node", F.col("n").alias("low"), F.col("n").alias("high"), F.col("counts").alias("top"))
    level1 = stage(boxes(entries, "leaf", "node"), "boxes")
    level2 = boxes(level1.select("cluster", F.col("parent").alias("node"), F.lit("").alias("root"), "low", "high", "top"),
                   "node", "root")
    asks = leaves.filter("query").select("cluster", F.col("doc_id").alias("a"), "n", "counts", "size")
    top = pruned(asks.join(level2.withColumnRenamed("box", "node"), "cluster"), "node")
    low = pruned(top.join(level1.select(F.col("parent").alias("node"), F.col("box").alias("leaf"), "low", "high", "top"), "node"), "leaf")
    # Many queries of one leaf are dealt over salts, the leaf is repeated for each.
    salts = F.ceil(F.col("size") / ASKED).cast("int")
    asked = low.withColumn("salt", F.pmod(F.xxhash64("a"), salts).cast("int"))
    points_of = leaves.select("leaf", "doc_id", "n", "counts", "query", F.explode(F.sequence(F.lit(0), salts - 1)).alias("salt"))
    return asked.groupBy("leaf", "salt").cogroup(points_of.groupBy("leaf", "salt")).applyInArrow(met, "a long, b long, bound long, open boolean")


# -- number of links ---------------------------------------------------------------------------

def overlaps(a: np.ndarray, na: np.ndarray, b: np.ndarray, nb: np.ndarray) -> np.ndarray:
    """Shared shingles of every set of one list with every set of another (hashes, one set after
    another, and their numbers)."""
    rows, columns = len(na), len(nb)
    out = np.zeros(rows * columns, np.int64)
    common = np.intersect1d(a, b)
    if not len(common):
        return out.reshape(rows, columns)
    sides = []
    for h, n in ((a, na), (b, nb)):
        at = np.minimum(np.searchsorted(common, h), len(common) - 1)
        hit = common[at] == h
        name, owner = at[hit], np.repeat(np.arange(len(n)), n)[hit]
        order = np.argsort(name, kind="stable")
        run = np.bincount(name, minlength=len(common))
        sides.append((owner[order], np.cumsum(run) - run, run))
    (own, start, run), (other, begin, size) = sides
    pairs = run * size
    # Shingles that many sets hold: as columns of two matrices. The others: pair by pair.
    dense = pairs > max(1, rows * columns // 400)
    names = np.flatnonzero(dense)
    for k in range(0, len(names), 4096):
        some = names[k:k + 4096]
        x, y = np.zeros((rows, len(some)), np.float32), np.zeros((columns, len(some)), np.float32)
        for m, o, s, r in ((x, own, start, run), (y, other, begin, size)):
            n = r[some]
            m[o[np.repeat(s[some] - (np.cumsum(n) - n), n) + np.arange(n.sum())], np.repeat(np.arange(len(some)), n)] = 1
        out += np.rint(x @ y.T).astype(np.int64).ravel()
    names = np.flatnonzero(~dense)
    step = np.cumsum(pairs[names]) >> 22
    for some in np.split(names, np.flatnonzero(step[1:] != step[:-1]) + 1) if len(names) else []:
        n = pairs[some]
        inner = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        width = np.repeat(size[some], n)
        i = own[np.repeat(start[some], n) + inner // width]
        out += np.bincount(i * columns + other[np.repeat(begin[some], n) + inner % width], minlength=len(out))
    return out.reshape(rows, columns)


def link_sums(table: pa.Table) -> pa.Table:
    """Per point of the first of two blocks the linked pairs of its copies and those of points in
    the second; in one block with itself each pair counts once."""
    same = table.column("a")[0].as_py() == table.column("b")[0].as_py()
    sides = []
    for side in (0,) if same else (0, 1):
        rows = table.filter(pa.compute.equal(table.column("side"), side)).drop_columns(["a", "b", "side"])
        keys = np.stack([np.asarray(rows.column(c).to_pylist(), np.int64) for c in ("fa", "fb")], 1).reshape(-1, 2)
        rows = rows.take(pa.array(np.unique(keys, axis=0, return_index=True)[1]))  # equal rows of one id
        found = [shingle_sets(values) for batch in rows.to_batches() for _, values in opened(batch, "raw")]
        h, n = (np.concatenate(x) for x in zip(*found))
        sides.append((h, n, *(np.asarray(rows.column(c).to_pylist(), np.int64) for c in ("doc_id", "copies"))))
    (ha, na, doc, mine), (hb, nb, _, theirs) = sides[0], sides[-1]
    shared = overlaps(ha, na, hb, nb)
    near = 100 * shared >= 80 * (na[:, None] + nb[None] - shared)
    if same:
        near = np.triu(near, 1)
    links = mine * (near @ theirs)
    some = np.flatnonzero(links)
    return pa.table({"doc_id": pa.array(doc[some], pa.int64()), "links": pa.array(links[some], pa.int64())})


def counted_links(p: DataFrame) -> DataFrame:
    """(doc_id, links): linked pairs of documents with different sets, each at one of its two
    representatives; several rows per document."""
    kept = ["cluster", "doc_id", "fa", "fb", "n", "copies"]
    order = ("cluster", "n", "fa", "fb", "doc_id")

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, points_in, size, last = (TaskContext.get().partitionId() << 40) - 1, 0, 0, None
        for batch in batches:
            names = []
            for cluster, n in zip(batch.column("cluster").to_pylist(), batch.column("n").to_pylist()):
                if cluster != last or points_in == BESIDE or size + n > BESIDE_SHINGLES:
                    block, points_in, size, last = block + 1, 0, 0, cluster
                points_in, size = points_in + 1, size + n
                names.append(block)
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), pa.array(names, pa.int64())], [*kept, "block"])

    ordered = p.select(*kept).distinct().repartitionByRange(parts(p.sparkSession), *order).sortWithinPartitions(*order)
    marked = stage(ordered.mapInArrow(assign, ", ".join(f"{c} long" for c in [*kept, "block"])), "blocks")
    spans = marked.groupBy("cluster", "block").agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count(F.lit(1)).alias("m"))
    a, b = (spans.select("cluster", *(F.col(c).alias(f"{c}_{s}") for c in ("block", "low", "high", "m"))) for s in "ab")
    pairs = a.join(b, "cluster").filter("block_a < block_b AND 5 * high_a >= 4 * low_b AND 5 * high_b >= 4 * low_a OR block_a = block_b AND m_a > 1") \
             .select(F.col("block_a").alias("a"), F.col("block_b").alias("b"))
    goes = pairs.select(F.col("a").alias("block"), "a", "b", F.lit(0).alias("side")) \
                .unionByName(pairs.filter("a <> b").select(F.col("b").alias("block"), "a", "b", F.lit(1).alias("side")))
    sent = marked.select("doc_id", "fa", "fb", "block").join(goes, "block").drop("block")
    rows = p.select("doc_id", "fa", "fb", "copies", "raw").join(sent, ["doc_id", "fa", "fb"])
    return rows.groupBy("a", "b").applyInArrow(link_sums, "doc_id long, links long")


# -- the join --------------------------------------------------------------------------------

def sets_of(docs: DataFrame) -> DataFrame:
    """doc_id, set size and fingerprint of every row."""
    def mark(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for keys, values in texts(batches, BLOCK):
            found, counts = shingle_sets(values)
            first, second = fingerprints(found, counts)
            yield pa.RecordBatch.from_arrays([pa.array(keys, pa.int64()), pa.array(counts.astype(np.int64)),
                                              pa.array(first.view(np.int64)), pa.array(second.view(np.int64))],
                                             ["doc_id", "n", "fa", "fb"])

    return docs.mapInArrow(mark, "doc_id long, n long, fa long, fb long")


def similar_documents(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", count_links: bool = True) -> DataFrame:
    """doc_id, n_shingles and component_id of every row, and n_links, the number of linked pairs of
    documents in the component, for those who need it."""
    # The result reads only the sets and the classes; all other tables are done with.
    with bounded_batches(docs.sparkSession, BATCH_BYTES), scratch(docs.sparkSession, "sets", "classes"):
        return linked_documents(id_and_text(docs, id_col, text_col), count_links)


def linked_documents(docs: DataFrame, count_links: bool) -> DataFrame:
    marks = stage(sets_of(docs), "sets")
    usable = marks.filter("n > 0 AND doc_id IS NOT NULL")
    total, rows = usable.agg(F.coalesce(F.sum("n"), F.lit(0)), F.count(F.lit(1))).first()
    drop = max(2, 64 - int(max(rows, 2)).bit_length() - 24)
    named = docs.filter("doc_id IS NOT NULL")
    found = stage(meetings(candidate_edges(named, total, drop, common_shingles(named, rows))), "meetings")
    clusters = components(able_edges(found))
    support = found.filter("a = b").select(F.col("a").alias("mark"), "w")
    classes = usable.groupBy("fa", "fb", "n").agg(F.min("doc_id").alias("doc_id"), F.count(F.lit(1)).alias("copies")) \
                    .withColumn("mark", F.shiftrightunsigned("fa", drop))
    nodes = stage(classes.join(clusters.withColumnRenamed("node", "mark").withColumnRenamed("component", "cluster"), "mark")
                  .join(support, "mark"), "nodes")
    p = stage(points(docs, nodes), "points")
    pivots = stage(nodes.groupBy("cluster").agg(F.max_by("doc_id", F.struct("w", -F.col("doc_id"))).alias("pivot"),
                                                F.count(F.lit(1)).alias("size")).filter("size > 1"), "pivots")
    near = stage(pivot_links(p, pivots), "pivot-links")
    # What the pivot does not link asks the tree of its cluster, unless the pivot was its only neighbour.
    open_ = p.join(pivots.filter("size > 2"), "cluster").filter("doc_id <> pivot") \
             .join(near.select(F.col("b").alias("doc_id")), "doc_id", "left_anti").select("cluster", "doc_id")
    open_ = stage(open_, "open")
    asking = p.join(pivots.join(open_.select("cluster").distinct(), "cluster").select("cluster", "size"), "cluster") \
              .join(open_.select("doc_id", F.lit(True).alias("q")), "doc_id", "left") \
              .select("cluster", "doc_id", "n", "counts", F.coalesce("q", F.lit(False)).alias("query"), "size", "c0", "c1")
    pairs = stage(tree_pairs(asking), "pairs")
    sides = lambda rows: verified(rows.join(beside(p, "a"), "a").join(beside(p, "b"), "b"))
    # First each open point against the settled point of its greatest bound: those linked are settled
    # too, and pairs of settled points, all linked to one pivot, need no look. The rest is verified.
    best = pairs.filter("NOT open").groupBy("a").agg(F.max_by("b", F.struct("bound", -F.col("b"))).alias("b"))
    late = stage(sides(best), "best-links")
    settled = late.select(F.col("a").alias("s")).distinct()
    left = pairs.join(settled.withColumnRenamed("s", "a").withColumn("sa", F.lit(True)), "a", "left") \
                .join(settled.withColumnRenamed("s", "b").withColumn("sb", F.lit(True)), "b", "left") \
                .filter("NOT (sa IS NOT NULL AND (sb IS NOT NULL OR NOT open))").select("a", "b")
    links = stage(near.unionByName(late).unionByName(sides(stage(left, "left"))), "links")
    joint = components(links)
    joint = joint.withColumnRenamed("node", "doc_id")
    named = classes.join(joint, "doc_id", "left").select(
        "fa", "fb", "n", "copies", F.col("component").isNotNull().alias("linked"), F.coalesce("component", "doc_id").alias("component"))
    extra = []
    if count_links:
        own = named.filter("copies > 1").select("component", F.expr("copies * (copies - 1) DIV 2").alias("links"))
        between = stage(counted_links(p), "link-sums").groupBy("doc_id").agg(F.sum("links").alias("links")) \
            .join(joint, "doc_id", "left").select(F.coalesce("component", "doc_id").alias("component"), "links")
        total = own.unionByName(between).groupBy("component").agg(F.sum("links").alias("links"))
        named = named.join(total, "component", "left")
        extra = [F.when(F.col("doc_id").isNotNull(), F.coalesce("links", F.lit(0))).alias("n_links")]
    named = named.filter("copies > 1 OR linked" + (" OR links > 0" if count_links else "")).drop("copies", "linked")
    joined_ = marks.join(stage(named, "classes"), ["fa", "fb", "n"], "left")
    return joined_.select("doc_id", F.col("n").alias("n_shingles"),
                          F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id")).alias("component_id"), *extra)
