"""Documents whose sets of word n-grams are alike, joined by prefix trees.

The join is exact for a Jaccard similarity given as num/100:

1. Documents with equal sets make a class; one of each class goes on.
2. A class of n n-grams can miss at most m = n - ceil(num n / 100) of them in a
   partner. Of a fixed share of all n-grams, chosen by hash, it must then share
   all but m with some other class. Classes that don't are done.
3. Of the rest, n-grams are ordered: rare ones by hash, frequent ones (a list of
   bounded size) after them by frequency. Two classes can only be alike if they
   share enough of the rare n-grams or, where those are few, one of their first
   m + 1 n-grams; classes so tied make clusters.
4. In a cluster the ordered sets are put into a prefix tree. A class is joined
   with all others by one walk in which sets with equal beginnings share the
   counting, and a subtree is left as soon as the n-grams that remain in its
   longest set cannot make up the overlap that is needed.

Within a cluster, sets are joined by bands of size, since alike ones have nearly
the same. A band of more than BLOCK classes is dealt into blocks: first at random,
twice, so that most copies are linked at linear cost, and then each pair of
blocks whose classes are not yet all connected meets in a task of its own.
Pairs within one component are not compared again.

Cases: null and wordless texts have no n-grams and are alike to nothing; texts
with fewer words than n have one, the whole; equal ids count as one document in
the components; a row without an id ties nothing and has the component of a
document with an equal set, null if there is none.
"""

from __future__ import annotations

import math
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .components import components
from .registry import query
from .shared import (
    NOT_BLANK,
    Words,
    chunks,
    gathered,
    gram_hashes,
    mixed,
    received,
    released,
    saved,
    send,
    table,
    texts,
)

# Share of all n-grams that the first filter compares.
SHARE = 0.25
# N-grams that are listed as frequent, at most; 12 bytes each are sent to tasks.
MAX_FREQUENT = 1 << 20
LEAST_FREQUENT = 16
# Classes that one task joins at most; so many of 2,000 n-grams on average.
BLOCK = 1000
# Ids that are sent to the scan of the texts, 16 bytes each; more are joined.
MAX_SENT_IDS = 2_000_000

_ROW_BITS = 10
_HASH_BITS = 64 - _ROW_BITS
_HASH = np.uint64((1 << _HASH_BITS) - 1)


def _sets(column: pa.Array, n: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """First row, sorted keys (row and n-gram) and set sizes of pieces of a column."""
    data, offsets = texts(column)
    for a, b in chunks(offsets):
        for lo in range(a, b, 1 << _ROW_BITS):
            hi = min(b, lo + (1 << _ROW_BITS))
            off = offsets[lo : hi + 1] - offsets[lo]
            words = Words(data[offsets[lo] : offsets[hi]], off, NOT_BLANK, lower=True)
            grams, first = gram_hashes(words, words.hashes(), n)
            row = words.row[first].astype(np.uint64)
            keys = np.unique((row << np.uint64(_HASH_BITS)) | (grams >> np.uint64(_ROW_BITS)))
            size = np.bincount((keys >> np.uint64(_HASH_BITS)).astype(np.int64), minlength=hi - lo)
            yield lo, keys & _HASH, size


def _digests(hashes: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two 64-bit digests of each set, the same for the same set."""
    out = []
    start = np.cumsum(size) - size
    full = np.flatnonzero(size)
    for salt in (0x1D, 0x2E5):
        total = np.zeros(len(size), np.uint64)
        if len(full):
            spread = mixed(hashes * np.uint64(2) + np.uint64(salt))
            total[full] = np.add.reduceat(spread, start[full])
        out.append(mixed(total + size.astype(np.uint64)).view(np.int64))
    return out[0], out[1]


def _heads(docs: DataFrame, n: int, share: float) -> DataFrame:
    """``doc_id``, set size, size of the compared share, digests, of each document."""
    limit = np.uint64(int(share * (1 << _HASH_BITS)))

    @released
    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = []
            for _, hashes, size in _sets(batch.column(1), n):
                row = np.repeat(np.arange(len(size)), size)
                some = np.bincount(row[hashes < limit], minlength=len(size))
                parts.append((size, some, *_digests(hashes, size)))
            if parts:
                columns = [pa.array(np.concatenate(x).astype(np.int64)) for x in zip(*parts)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0), *columns], names=["doc_id", "n", "s", "d1", "d2"]
                )

    return docs.select("doc_id", "text").mapInArrow(
        measure, "doc_id bigint, n bigint, s bigint, d1 bigint, d2 bigint"
    )


_POSTING = np.dtype([("h", "<u8"), ("d", "<i8")])


def _shared_counts(docs: DataFrame, n: int, share: float) -> DataFrame:
    """``d1, k``: how many compared n-grams of a class are in another class too.

    Postings travel packed, by ranges of hashes. An n-gram that two classes of
    one batch share is counted there; only a mark of it travels, so a frequent
    one sends each task a row and no more.
    """
    limit = np.uint64(int(share * (1 << _HASH_BITS)))
    buckets = 8 * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    width = np.uint64(int(limit) // buckets + 1)

    def counted(d: np.ndarray) -> pa.RecordBatch:
        names, k = np.unique(d, return_counts=True)
        return pa.RecordBatch.from_arrays([pa.array(names), pa.array(k)], names=["d1", "k"])

    def shared(postings: np.ndarray) -> np.ndarray:
        """Of postings sorted by hash, those whose hash occurs more than once."""
        same = postings["h"][1:] == postings["h"][:-1]
        out = np.zeros(len(postings), bool)
        out[1:] |= same
        out[:-1] |= same
        return out

    @released
    def post(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            held, seen = [], np.zeros(0, np.int64)
            for _, hashes, size in _sets(batch.column(0), n):
                digest, _ = _digests(hashes, size)
                fresh = np.zeros(len(size), bool)
                fresh[np.unique(digest, return_index=True)[1]] = True
                fresh &= ~np.isin(digest, seen)
                seen = np.concatenate([seen, digest[fresh]])
                row = np.repeat(np.arange(len(size)), size)
                keep = (hashes < limit) & fresh[row]
                part = np.empty(int(keep.sum()), _POSTING)
                part["h"], part["d"] = hashes[keep], digest[row[keep]]
                held.append(part)
            postings = np.concatenate(held) if held else np.zeros(0, _POSTING)
            if not len(postings):
                continue
            postings = postings[np.argsort(postings["h"], kind="stable")]
            common = shared(postings)
            names, k = np.unique(postings["d"][common], return_counts=True)
            first = common.copy()
            first[1:] &= postings["h"][1:] != postings["h"][:-1]
            marks = postings[first]
            marks["d"] = 0  # no class: tells others that the n-gram is shared
            rest = np.concatenate([postings[~common], marks, marks])
            rest = rest[np.argsort(rest["h"], kind="stable")]
            bucket = (rest["h"] // width).astype(np.int64)
            own, start = np.unique(bucket, return_index=True)
            blobs = [x.tobytes() for x in np.split(rest, start[1:])]
            counts = np.empty(len(names), _POSTING)
            counts["h"], counts["d"] = k, names
            yield pa.RecordBatch.from_arrays(
                [
                    pa.array([*own.tolist(), int(own[0])], pa.int32()),
                    pa.array([False] * len(own) + [True]),
                    pa.array([*blobs, counts.tobytes()], pa.binary()),
                ],
                names=["bucket", "counted", "data"],
            )

    @released
    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        at, held, found, size = None, [], [], 0
        for batch in batches:
            for bucket, done, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                part = np.frombuffer(data, _POSTING)
                if done:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(part["d"].copy()), pa.array(part["h"].astype(np.int64))],
                        names=["d1", "k"],
                    )
                    continue
                if bucket != at:
                    found.append(meet(held))
                    size += len(found[-1])
                    at, held = bucket, []
                    if size > 2_000_000:
                        yield counted(np.concatenate(found))
                        found, size = [], 0
                held.append(part)
        found.append(meet(held))
        yield counted(np.concatenate(found))

    def meet(held: list[np.ndarray]) -> np.ndarray:
        if not held:
            return np.zeros(0, np.int64)
        # a class may come from several tasks: once each
        postings = np.concatenate(held)
        real = np.unique(postings[postings["d"] != 0])
        marks = postings[postings["d"] == 0]
        postings = np.concatenate([real, marks])
        postings = postings[np.argsort(postings["h"], kind="stable")]
        d = postings["d"][shared(postings)]
        return d[d != 0]

    packed = docs.select("text").mapInArrow(post, "bucket int, counted boolean, data binary")
    parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    dealt = packed.repartition(parts, "bucket").sortWithinPartitions("bucket")
    return dealt.mapInArrow(compare, "d1 bigint, k bigint").groupBy("d1").agg(F.sum("k").alias("k"))


def _full_sets(docs: DataFrame, chosen: DataFrame, n: int) -> DataFrame:
    """``id, data``: the packed n-grams of the documents in ``chosen`` (``id``)."""
    if chosen.count() <= MAX_SENT_IDS:
        chosen = F.broadcast(chosen)
    picked = docs.select(F.col("doc_id").alias("id"), "text").join(chosen, "id", "left_semi")

    @released
    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            blobs: list[bytes] = []
            for _, hashes, size in _sets(batch.column(1), n):
                blobs += [x.tobytes() for x in np.split(hashes, np.cumsum(size)[:-1])]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(blobs, pa.binary())], names=["id", "data"]
            )

    return picked.mapInArrow(pack, "id bigint, data binary")


def _slices(batches: Iterator[pa.RecordBatch], rows: int = 500) -> Iterator[pa.RecordBatch]:
    """Smaller batches, for work that needs many times a batch's memory."""
    for batch in batches:
        for at in range(0, len(batch), rows):
            yield batch.slice(at, rows)


def _frequent(sets: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """The most frequent n-grams of all sets, sorted, and their numbers of sets."""

    @released
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in _slices(batches, 2000):
            hashes, k = np.unique(
                np.frombuffer(b"".join(batch.column(0).to_pylist()), np.uint64), return_counts=True
            )
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes.astype(np.int64)), pa.array(k)], names=["h", "k"]
            )

    counts = sets.select("data").mapInArrow(count, "h bigint, k bigint").groupBy("h")
    counts = counts.agg(F.sum("k").alias("k")).where(F.col("k") >= LEAST_FREQUENT)
    counts = saved(gathered(counts))
    # rows by number of sets: at most a few thousand different numbers of digits
    sizes = counts.groupBy(F.floor(F.log2("k") * 4).alias("b")).count().orderBy(F.desc("b")).collect()
    least, total = None, 0
    for row in sizes:
        total += row["count"]
        if total > MAX_FREQUENT:
            break
        least = row["b"]
    if least is None:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    listed = counts.where(F.floor(F.log2("k") * 4) >= least).orderBy("h").toPandas()
    return listed["h"].to_numpy(np.uint64), listed["k"].to_numpy(np.int64)


def _often(hashes: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Of n-grams, how many sets have them, 0 where that is not listed as frequent."""
    names, k = frequent
    if not len(names):
        return np.zeros(len(hashes), np.int64)
    at = np.minimum(np.searchsorted(names, hashes), len(names) - 1)
    return np.where(names[at] == hashes, k[at], 0)


def _ordered(hashes: np.ndarray, frequent: tuple[np.ndarray, np.ndarray]) -> np.ndarray:
    """Places of n-grams (sorted by hash) in the global order."""
    return np.argsort(_often(hashes, frequent), kind="stable")


def allowed_misses(n: np.ndarray, num: int) -> np.ndarray:
    return n - -(-num * n // 100)


def _clusters(sets: DataFrame, frequent, num: int, share: float) -> tuple[DataFrame, DataFrame]:
    """``id, cluster`` of classes that may be alike, and ``id, n, need`` of all.

    Of the rare n-grams in the compared share a class has r. If r is more than
    the class can miss, a partner has all but those missed, ``need`` of them, so
    pairs are counted over the few classes of each rare n-gram. Classes with
    fewer, which consist of frequent n-grams or are short, are tied to each
    other where they share one of their first n-grams.
    """
    sent = send(sets.sparkSession.sparkContext, frequent)
    limit = np.uint64(int(share * (1 << _HASH_BITS)))
    kind = "h bigint, id bigint, rare boolean, n bigint, need bigint"

    @released
    def first(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed = received(sent)
        for batch in _slices(batches):
            ids, grams, rare, sizes, needs = [], [], [], [], []

            def add(name: int, hashes: np.ndarray, is_rare: bool, n: int, need: int) -> None:
                grams.append(hashes.astype(np.int64))
                for out, value in ((ids, name), (rare, is_rare), (sizes, n), (needs, need)):
                    out.append(np.full(len(hashes), value))

            for name, data in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                hashes = np.frombuffer(data, np.uint64)
                misses = int(allowed_misses(np.int64(len(hashes)), num))
                some = hashes[: np.searchsorted(hashes, limit)]
                some = some[_often(some, listed) == 0]
                need = len(some) - misses
                add(name, some, True, len(hashes), need)
                if need < 1:
                    chosen = _ordered(hashes, listed)[: misses + 1]
                    add(name, hashes[chosen], False, len(hashes), need)
            if ids:
                columns = (np.concatenate(x) for x in (grams, ids, rare, sizes, needs))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(x) for x in columns], names=["h", "id", "rare", "n", "need"]
                )

    postings = saved(sets.select("id", "data").mapInArrow(first, kind))
    meta = postings.groupBy("id").agg(
        F.min("n").alias("lo"), F.max("n").alias("hi"), F.min("need").alias("need")
    )
    meta = saved(gathered(meta))
    rare = postings.where("rare").select("h", "id").distinct()
    pairs = (
        rare.withColumnRenamed("id", "u").join(rare.withColumnRenamed("id", "v"), "h")
        .where("u > v").groupBy("u", "v").count()
    )
    for side in ("u", "v"):
        own = meta.select(F.col("id").alias(side), *[F.col(c).alias(f"{c}_{side}") for c in meta.columns[1:]])
        pairs = pairs.join(own, side)
    pairs = pairs.where(
        f"count >= need_u AND count >= need_v AND (need_u > 0 OR need_v > 0) "
        f"AND 100 * least(hi_u, hi_v) >= {num} * greatest(lo_u, lo_v)"
    ).select("u", "v")
    poor = postings.where("NOT rare").select("h", "id")
    least = poor.groupBy("h").agg(F.min("id").alias("v"), F.max("id").alias("top"))
    least = least.where("v <> top").select("h", "v")
    stars = poor.join(least, "h").where("id <> v").select(F.col("id").alias("u"), "v")
    tied = components(pairs.union(stars))
    return tied.union(tied.select(F.col("component").alias("id"), "component").distinct()).select(
        "id", F.col("component").alias("cluster")
    ), meta


class PrefixTree:
    """Sets as sequences of numbers in rising order, sharing equal beginnings.

    A node has a run of numbers, the number before its run, children, the length
    of the longest and shortest sets below, and the sets that end with the run.
    """

    def __init__(self, sequences: list[np.ndarray], num: int) -> None:
        self.sequences, self.num = sequences, num
        self.size = np.array([len(s) for s in sequences])
        # numbers that are compared byte by byte in their own order
        keys = [s.astype(">u4").tobytes() for s in sequences]
        order = sorted(range(len(sequences)), key=keys.__getitem__)
        self.run: list[np.ndarray] = []
        self.depth: list[int] = []
        self.up: list[int] = []
        self.children: list[list[int]] = []
        self.longest: list[int] = []
        self.shortest: list[int] = []
        self.done: list[list[int]] = []
        self.leaf = [0] * len(sequences)
        self._build(order)
        self._index()

    def _build(self, order: list[int]) -> None:
        todo = [(order, 0, -1)]
        while todo:
            own, depth, up = todo.pop()
            first, last = self.sequences[own[0]], self.sequences[own[-1]]
            most = min(len(first), len(last))
            other = np.flatnonzero(first[depth:most] != last[depth:most])
            end = depth + int(other[0]) if len(other) else most
            node = len(self.run)
            self.run.append(first[depth:end])
            self.depth.append(depth)
            self.up.append(up)
            self.children.append([])
            self.longest.append(int(self.size[own].max()))
            self.shortest.append(int(self.size[own].min()))
            if up >= 0:
                self.children[up].append(node)
            at = 0
            while at < len(own) and self.size[own[at]] == end:
                self.leaf[own[at]] = node
                at += 1
            self.done.append(own[:at])
            while at < len(own):
                token, stop = self.sequences[own[at]][end], at + 1
                while stop < len(own) and self.sequences[own[stop]][end] == token:
                    stop += 1
                todo.append((own[at:stop], end, node))
                at = stop

    def _index(self) -> None:
        """By number, the sets that have it among their first ones."""
        firsts = allowed_misses(self.size, self.num) + 1
        self.first = [s[:m] for s, m in zip(self.sequences, firsts.tolist(), strict=True)]
        number = np.concatenate(self.first)
        owner = np.repeat(np.arange(len(firsts)), [len(f) for f in self.first])
        order = np.argsort(number, kind="stable")
        self.owner = owner[order]
        self.at = np.searchsorted(number[order], np.arange(int(number.max()) + 2))

    def alike(self, probe: int, skip: np.ndarray, has: np.ndarray) -> list[int]:
        """Earlier sets with a Jaccard similarity of num/100 or more to ``probe``.

        ``skip`` marks sets that need not be looked at; ``has``, all false, is
        room for the probe's numbers.
        """
        own, size = self.sequences[probe], int(self.size[probe])
        first = self.first[probe]
        first = first[self.at[first + 1] - self.at[first] > 1]
        if not len(first):
            return []
        # only paths to sets that share one of the first numbers are walked
        tied = np.concatenate([self.owner[self.at[t] : self.at[t + 1]] for t in first])
        ties = np.unique(tied[(tied < probe) & ~skip[tied]])
        lengths = self.size[ties]
        ties = ties[(100 * lengths >= self.num * size) & (100 * size >= self.num * lengths)]
        if not len(ties):
            return []
        marked: set[int] = set()
        for node in map(self.leaf.__getitem__, ties.tolist()):
            while node >= 0 and node not in marked:
                marked.add(node)
                node = self.up[node]
        wanted, found = set(ties.tolist()), []
        has[own] = True
        stack = [(0, 0)]
        while stack:
            node, overlap = stack.pop()
            longest = self.longest[node]
            need = -(-self.num * (size + self.shortest[node]) // (100 + self.num))
            spare = longest - self.depth[node] + overlap - -(-self.num * (size + longest) // (100 + self.num))
            if spare < 0 or size < need:
                continue
            run = self.run[node]
            shared = int(np.count_nonzero(has[run]))
            if len(run) - shared > spare:
                continue
            overlap += shared
            for other in self.done[node]:
                union = size + int(self.size[other]) - overlap
                if other in wanted and 100 * overlap >= self.num * union:
                    found.append(other)
            stack += [(c, overlap) for c in self.children[node] if c in marked]
        has[own] = False
        return found


def _tree_links(
    ids: Sequence[int],
    parts: Sequence[int],
    lower: Sequence[bool],
    data: Sequence[bytes],
    frequent,
    num: int,
) -> list[tuple[int, int]]:
    """Links that connect what is alike within a group.

    ``parts`` are known components; pairs of two ``lower`` sets are left out.
    """
    hashes = [np.frombuffer(d, np.uint64) for d in data]
    every = np.unique(np.concatenate(hashes))
    rank = np.empty(len(every), np.int64)
    rank[_ordered(every, frequent)] = np.arange(len(every))
    tree = PrefixTree([np.sort(rank[np.searchsorted(every, h)]) for h in hashes], num)
    part = np.unique(np.array(parts, np.int64), return_inverse=True)[1]
    low = np.array(lower, bool)
    has, links = np.zeros(len(every), bool), []
    for i in range(len(ids)):
        skip = part == part[i]
        if low[i]:
            skip |= low
        for j in tree.alike(i, skip, has):
            if part[j] != part[i]:
                part[part == part[j]] = part[i]
                links.append((ids[i], ids[j]))
    return links


def _join_groups(grouped: DataFrame, frequent, num: int) -> DataFrame:
    """``u, v`` links from rows ``g, id, part, data``; each group has a bounded size."""
    sent = send(grouped.sparkSession.sparkContext, frequent)
    parts = int(grouped.sparkSession.conf.get("spark.sql.shuffle.partitions"))

    @released
    def join(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        listed, at, held = received(sent), None, []

        def linked() -> pa.RecordBatch:
            links = []
            if len(held) > 1:
                links = _tree_links(*zip(*held, strict=True), listed, num)
            return pa.RecordBatch.from_arrays(
                [pa.array([x[k] for x in links], pa.int64()) for k in (0, 1)], names=["u", "v"]
            )

        for batch in batches:
            for g, *row in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                if g != at:
                    yield linked()
                    at, held = g, []
                held.append(row)
        yield linked()

    dealt = grouped.select("g", "id", "part", "low", "data").repartition(parts, "g")
    return dealt.sortWithinPartitions("g", "id").mapInArrow(join, "u bigint, v bigint")


def _connected(links: DataFrame) -> DataFrame:
    """``id, part`` for ids in links, the components' least ones included."""
    tied = components(links)
    return tied.union(tied.select(F.col("component").alias("id"), "component").distinct()).select(
        "id", F.col("component").alias("part")
    )


def _with_parts(sets: DataFrame, parts: DataFrame) -> DataFrame:
    return sets.join(parts, "id", "left").withColumn("part", F.coalesce("part", "id"))


def _weight():
    """How many classes of 2,000 n-grams some classes count as, one each at least."""
    return F.greatest(F.count("*"), F.ceil(F.sum("hi") / 2000))


def similar_classes(sets: DataFrame, num: int, block: int = BLOCK, share: float = SHARE) -> DataFrame:
    """``u, v``: links between ``sets`` (``id, data``) that connect all that are alike.

    Groups are planned on ids and sizes; the sets join them last.
    """
    frequent = _frequent(sets)
    clusters, meta = _clusters(sets, frequent, num, share)
    # Alike sets differ in size by a band at most: each set goes to its own band and
    # the next. Pairs of sets from the lower band are left to that band.
    width = max(-math.log(num / 100), 1e-6) * (1 + 1e-9)
    lowest, highest = F.floor(F.log("lo") / width), F.floor(F.log("hi") / width)
    banded = clusters.join(meta, "id").select(
        "id", "cluster", "hi", F.explode(F.sequence(lowest, highest + 1)).alias("band"),
        highest.alias("top"),
    )
    tied = banded.select(
        "id", "hi", F.xxhash64("cluster", "band").alias("cluster"),
        (F.col("band") > F.col("top")).alias("low"),
    )
    tied = saved(gathered(tied))
    sizes = tied.groupBy("cluster").agg(
        _weight().alias("size"), F.min("low").alias("all_low"), F.count("*").alias("k")
    )
    sizes = sizes.where("k > 1 AND NOT all_low").select("cluster", "size")
    members = saved(tied.join(sizes, "cluster"))

    def joined(groups: DataFrame) -> DataFrame:
        return _join_groups(groups.join(sets, "id"), frequent, num)

    # clusters that fit into a block are joined whole
    small = members.where(F.col("size") <= block).select(
        F.xxhash64(F.lit(-1), "cluster").alias("g"), "id", F.col("id").alias("part"), "low"
    )
    # the blocks of larger ones are dealt at random
    blocks = F.ceil(F.col("size") / (block * 0.8))
    large = members.where(F.col("size") > block)
    first = large.select(
        F.xxhash64(F.lit(0), "cluster", F.pmod(F.xxhash64("id"), blocks)).alias("g"),
        "id", F.col("id").alias("part"), "low",
    )
    links = saved(joined(small.union(first)))
    if large.isEmpty():
        return links
    parts = saved(gathered(_connected(links)))
    again = _with_parts(large, parts).select(
        F.xxhash64(F.lit(1), "cluster", F.pmod(F.xxhash64("id", F.lit(1)), blocks)).alias("g"),
        "id", "part", "low",
    )
    tied = parts.where("id <> part").select(F.col("id").alias("u"), F.col("part").alias("v"))
    links = saved(tied.union(joined(again)))
    parts = saved(gathered(_connected(links)))
    # blocks of one component, or of several small ones; pairs that are connected need no task
    known = _with_parts(large.drop("size"), parts)
    held = known.groupBy("cluster", "part").agg(_weight().alias("k"))
    whole = held.groupBy("cluster").agg(F.count("*").alias("parts"))
    held = held.join(whole.where("parts > 1"), "cluster").drop("parts")
    rest = held.where(F.col("k") < block).groupBy("cluster").agg(F.sum("k").alias("mixed"))
    held = held.join(rest, "cluster", "left")
    pure = F.col("k") >= block
    spot = F.when(
        pure, F.xxhash64("part", F.pmod(F.xxhash64("id"), F.ceil(F.col("k") / (block * 0.4))))
    ).otherwise(F.pmod(F.xxhash64("id"), F.ceil(F.col("mixed") / (block * 0.4))))
    placed = saved(
        known.join(held, ["cluster", "part"]).select("cluster", "id", "part", "low", spot.alias("spot"))
    )
    spots = placed.groupBy("cluster", "spot").agg(
        F.min("part").alias("lo"), F.max("part").alias("hi")
    )
    other = spots.select("cluster", *[F.col(c).alias(f"{c}2") for c in ("spot", "lo", "hi")])
    pairs = spots.join(other, "cluster").where(
        "spot <= spot2 AND NOT (lo = hi AND lo2 = hi2 AND lo = lo2)"
    )
    pairs = saved(
        pairs.select("cluster", "spot", "spot2", F.xxhash64(F.lit(2), "cluster", "spot", "spot2").alias("g"))
    )
    ends = pairs.select("cluster", "spot", "g").union(
        pairs.where("spot <> spot2").select("cluster", F.col("spot2").alias("spot"), "g")
    )
    last = placed.join(ends, ["cluster", "spot"]).select("g", "id", "part", "low")
    tied = parts.where("id <> part").select(F.col("id").alias("u"), F.col("part").alias("v"))
    return tied.union(joined(last))


def join_ngrams(
    docs: DataFrame, n: int = 5, num: int = 80, block: int = BLOCK, share: float = SHARE
) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of ``docs`` (``doc_id, text``).

    Documents link where the Jaccard similarity of their sets of ``n`` words is
    ``num``/100 or more; a component's id is its least document id.
    """
    docs = docs.select("doc_id", "text")
    heads = saved(_heads(docs, n, share))
    classes = heads.where("n > 0 AND doc_id IS NOT NULL").groupBy("n", "s", "d1", "d2")
    classes = saved(gathered(classes.agg(F.min("doc_id").alias("id"))))
    shared = _shared_counts(docs, n, share)
    misses = F.expr(f"n - CAST(CEIL({num} * n / 100.0D - 1e-9) AS BIGINT)")
    near = classes.join(shared, "d1", "left").where(
        F.coalesce("k", F.lit(0)) >= F.col("s") - misses
    )
    # used for the size check and for the sets
    chosen = saved(gathered(near.select("id").distinct()))
    sets = saved(_full_sets(docs, chosen, n))
    links = similar_classes(sets, num, block, share)
    parts = _connected(links)
    found = classes.join(parts, "id", "left").select(
        "n", "d1", "d2", F.coalesce("part", "id").alias("component_id")
    )
    joined = heads.join(found, ["n", "d1", "d2"], "left")
    return joined.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id")
    )


@query("op7_ngram_join")
def op7_ngram_join(spark: SparkSession, folder: str) -> DataFrame:
    return join_ngrams(table(spark, folder, "documents"), n=4, num=85)
