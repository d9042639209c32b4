"""Similarity join of word-shingle sets: size-banded tiles, hashed bitmaps, exact sorted intersections.

Sets that are equal are one class. Two sets that link share a shingle among the first n - ceil(0.75 n) + 1
of each in any common order (prefix filter); frequent shingles come last in the order, so that passages
many documents share seldom lead to candidates. The classes that share such a shingle form its list.
Short lists give their pairs; in long lists every class is first compared with a few pivots of its size
band and of the next, and what that leaves in different components is compared in tiles: blocks of
bounded size of the same or neighbouring size bands. Pairs whose bitmaps rule out enough overlap are dropped by bit counts, the
others are intersected exactly. No link between different components is lost; links inside one are not all looked up.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from recallspark.llm.batches import pieces, texts
from recallspark.llm.components import components
from recallspark.llm.storage import stored
from recallspark.llm.word_sets import shingle_sets

#: Two sets link when PERCENT is at most their intersection over their union; words of a shingle.
PERCENT, WIDTH = 75, 5
#: Shingles that the order puts last: the most frequent ones, at most so many (eight megabytes in all).
FREQUENT = 500_000
#: Members up to which a list gives all its pairs; members of a block of a tile.
SHORT_LIST, BLOCK = 8, 512
#: Bits of a bitmap: a power of two over four times the set's size, within these bounds.
MIN_BITS, MAX_BITS = 256, 32_768
#: Ids that may be broadcast (8 bytes each); beyond, the rows are joined by a shuffle.
BROADCAST_ROWS = 1_000_000


def prefix_size(n: int, percent: int = PERCENT) -> int:
    return n - -(-n * percent // 100) + 1


def bitmap(shingles: np.ndarray) -> bytes:
    bits = MIN_BITS
    while bits < 4 * len(shingles) and bits < MAX_BITS:
        bits *= 2
    marked = np.zeros(bits, dtype=np.uint8)
    marked[(shingles & np.uint64(bits - 1)).astype(np.int64)] = 1
    whole = np.packbits(marked, bitorder="little").tobytes()
    return len(whole).to_bytes(4, "little") + pa.compress(whole, codec="zstd", asbytes=True)


def folded(bitmaps: list[bytes]) -> np.ndarray:
    """The (compressed) bitmaps as rows of words, all folded to the narrowest width among them."""
    widths = [int.from_bytes(b[:4], "little") for b in bitmaps]
    words = min(widths) // 8
    return np.stack([np.bitwise_or.reduce(np.frombuffer(pa.decompress(b[4:], decompressed_size=w, codec="zstd"), np.uint64).reshape(-1, words), axis=0)
                     for b, w in zip(bitmaps, widths)])


def overlap_bound(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """The most that sets can share: each bit set in one only stands for an element of that one only."""
    only_a = np.bitwise_count(a & ~b).sum(axis=-1, dtype=np.int64)
    only_b = np.bitwise_count(b & ~a).sum(axis=-1, dtype=np.int64)
    return np.minimum(n_a - only_a, n_b - only_b)


def links(shared, n_a, n_b, percent: int = PERCENT):
    return 100 * shared >= percent * (n_a + n_b - shared)


def _key(shingles: np.ndarray) -> int:
    return int.from_bytes(blake2b(shingles.tobytes(), digest_size=8).digest(), "little", signed=True)


def _survey(docs: DataFrame) -> DataFrame:
    """Per document its set's size, key and bitmap; besides, shingles frequent within a task with their counts."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        for batch in pieces(batches, limit=6_000_000):
            sets = [s for piece in pieces(iter([batch])) for s in shingle_sets(texts(piece))]
            keys = [_key(s) for s in sets]
            new = {k: s for k, s in zip(keys, sets) if k not in seen and len(s)}
            seen.update(new)
            values, counts = np.unique(np.concatenate(list(new.values())), return_counts=True) if new else (np.zeros(0, np.uint64),) * 2
            often = counts >= 2
            n, m = len(sets), int(often.sum())
            none = [None] * m
            yield pa.RecordBatch.from_arrays(
                [pa.concat_arrays([batch.column(0).cast(pa.int64()), pa.array(none, pa.int64())]), pa.array([len(s) for s in sets] + none, pa.int64()),
                 pa.array(keys + none, pa.int64()), pa.array([bitmap(s) if len(s) else None for s in sets] + none, pa.binary()),
                 pa.array([None] * n + values[often].view(np.int64).tolist(), pa.int64()), pa.array([None] * n + counts[often].tolist(), pa.int64())],
                names=["doc_id", "n", "key", "bitmap", "shingle", "times"])

    return docs.mapInArrow(run, "doc_id long, n long, key long, bitmap binary, shingle long, times long")


def _postings(docs: DataFrame, frequent: np.ndarray, percent: int) -> DataFrame:
    """``shingle, key, n`` of the prefix of every set; ``frequent`` shingles, the most frequent last, end the order."""
    order = np.argsort(frequent)
    sent = docs.sparkSession.sparkContext.broadcast((frequent[order], order))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, rank = sent.value
        seen: set[int] = set()
        for batch in pieces(batches):
            parts, keys, sizes = [], [], []
            for s in shingle_sets(texts(batch)):
                key = _key(s)
                if not len(s) or key in seen:
                    continue
                seen.add(key)
                if len(known):
                    at = np.minimum(np.searchsorted(known, s), len(known) - 1)
                    late = known[at] == s
                    ordered = np.concatenate((s[~late], s[late][np.argsort(rank[at[late]])]))
                else:
                    ordered = s
                parts.append(ordered[:prefix_size(len(s), percent)])
                keys.append(key)
                sizes.append(len(s))
            if parts:
                times = [len(p) for p in parts]
                yield pa.RecordBatch.from_arrays(
                    [pa.array(np.concatenate(parts).view(np.int64)), pa.array(np.repeat(np.array(keys, np.int64), times)),
                     pa.array(np.repeat(np.array(sizes, np.int64), times))], names=["shingle", "key", "n"])

    return docs.mapInArrow(run, "shingle long, key long, n long")


def pivot_pairs(sizes: np.ndarray, percent: int) -> Iterator[tuple[int, int]]:
    """Pairs (smaller, larger) of a list sorted by size: each with its band's first, middle and last, and the next band's first."""
    low = 0
    while low < len(sizes):
        high = int(np.searchsorted(sizes, sizes[low] * 100 // percent, side="right"))
        for pivot in {low, (low + high) // 2, high - 1, min(high, len(sizes) - 1)}:
            yield from ((min(i, pivot), max(i, pivot)) for i in range(low, high) if i != pivot)
        low = high


def _candidates(postings: DataFrame, percent: int) -> DataFrame:
    """``a, n_a, b, n_b, list``: pairs to compare (list null), and the members of long lists (as a; b null)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kept = np.zeros((3, 0), dtype=np.int64)  # rows of the last list so far
        open_list: int | None = None  # the shingle of a long list that goes on
        told: set[tuple[int, int]] = set()

        def work(rows: np.ndarray, last: bool) -> tuple[np.ndarray, list]:
            nonlocal open_list
            shingle, key, n = rows
            fresh = np.ones(len(key), dtype=bool)
            fresh[1:] = (shingle[1:] != shingle[:-1]) | (key[1:] != key[:-1])
            shingle, key, n = (x[fresh] for x in rows)
            starts = np.flatnonzero(np.concatenate(([True], shingle[1:] != shingle[:-1]))) if len(key) else np.zeros(0, np.int64)
            counts = np.diff(np.append(starts, len(key)))
            end, out = len(key), []
            if not last and len(starts) and counts[-1] <= 100_000:
                end, starts, counts = starts[-1], starts[:-1], counts[:-1]
            many = counts >= 2
            if open_list is not None and len(starts) and shingle[0] == open_list:
                many[0] = True
            for s, c in zip(starts[many].tolist(), counts[many].tolist()):
                ks, ns = key[s:s + c], n[s:s + c]
                if c <= SHORT_LIST and open_list != shingle[s]:
                    pairs = [(i, j) for i in range(c) for j in range(i + 1, c)]
                else:
                    open_list = int(shingle[s])
                    out += [(k, m, None, None, open_list) for k, m in zip(ks.tolist(), ns.tolist())]
                    pairs = pivot_pairs(ns, percent)
                ks, ns = ks.tolist(), ns.tolist()
                for i, j in pairs:
                    if 100 * ns[i] >= percent * ns[j] and ks[i] != ks[j]:
                        i, j = (i, j) if ks[i] < ks[j] else (j, i)
                        pair = (ks[i], ks[j])
                        if pair not in told:
                            told.add(pair)
                            out.append((ks[i], ns[i], ks[j], ns[j], None))
                if len(told) > 200_000:
                    told.clear()
            return np.stack([x[end:] for x in (shingle, key, n)]), out

        def table(out: list) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(list(c), pa.int64()) for c in zip(*out)], names=["a", "n_a", "b", "n_b", "list"])

        for batch in batches:
            new = np.stack([batch.column(i).to_numpy() for i in range(3)])
            kept, out = work(np.concatenate((kept, new), axis=1), False)
            if out:
                yield table(out)
        kept, out = work(kept, True)
        if out:
            yield table(out)

    grouped = postings.repartition("shingle").sortWithinPartitions("shingle", "n", "key")
    return grouped.mapInArrow(run, "a long, n_a long, b long, n_b long, list long")


def _possible(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs ``a, b`` that their bitmaps do not rule out."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n_a, n_b = batch.column(2).to_numpy(), batch.column(3).to_numpy()
            maps = list(zip(batch.column(4).to_pylist(), batch.column(5).to_pylist()))
            keep = np.zeros(len(maps), dtype=bool)
            for i, pair in enumerate(maps):
                rows = folded(list(pair))
                keep[i] = links(overlap_bound(rows[0], rows[1], n_a[i], n_b[i]), n_a[i], n_b[i], percent)
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep))

    side = lambda name: sets.select(F.col("key").alias(name), F.col("n").alias(f"n_{name}"), F.col("bitmap").alias(f"bitmap_{name}"))
    whole = pairs.select("a", "b").join(side("a"), "a").join(side("b"), "b")
    return whole.select("a", "b", "n_a", "n_b", "bitmap_a", "bitmap_b").mapInArrow(run, "a long, b long")


def _linked(pairs: DataFrame, docs: DataFrame, sets: DataFrame, percent: int, broadcast_rows: int) -> DataFrame:
    """The pairs ``a, b`` that link, by exact intersection of the sorted sets, made again from the texts."""
    def again(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in pieces(batches):
            found = [(_key(s), s.tobytes()) for s in shingle_sets(texts(batch))]
            yield pa.RecordBatch.from_arrays([pa.array([f[0] for f in found], pa.int64()), pa.array([f[1] for f in found], pa.binary())],
                                             names=["key", "shingles"])

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch.column(2), batch.column(3)):
                one, two = np.frombuffer(x.as_buffer(), np.uint64), np.frombuffer(y.as_buffer(), np.uint64)
                shared = len(np.intersect1d(one, two, assume_unique=True))
                keep.append(bool(links(shared, len(one), len(two), percent)))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1)], names=["a", "b"]).filter(pa.array(keep, pa.bool_()))

    needed = pairs.select(F.col("a").alias("key")).unionByName(pairs.select(F.col("b").alias("key"))).distinct()
    ids = stored(needed.join(sets, "key").select(F.col("class_id").alias("doc_id"), "key"))
    few = ids.count() <= broadcast_rows
    rows = docs.join(F.broadcast(ids.select("doc_id")) if few else ids.select("doc_id"), "doc_id", "left_semi")
    if ids.filter("doc_id IS NULL").limit(1).count():  # sets whose rows all have a null id
        rows = rows.unionByName(docs.filter("doc_id IS NULL"))
    # rows that share an id with a needed one make sets too: only the needed keys count, once each
    made = rows.mapInArrow(again, "key long, shingles binary").join(ids.select("key"), "key", "left_semi").dropDuplicates(["key"])
    whole = (pairs.join(made.select(F.col("key").alias("a"), F.col("shingles").alias("set_a")), "a")
             .join(made.select(F.col("key").alias("b"), F.col("shingles").alias("set_b")), "b"))
    return whole.select("a", "b", "set_a", "set_b").mapInArrow(compare, "a long, b long")


def _tiles(members: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Possible pairs ``a, b`` of different components within long lists ``list, key, component``."""
    member = members.join(sets.select("key", "n"), "key").withColumn(
        "band", F.floor(F.log(F.col("n").cast("double")) / float(np.log(100 / percent))).cast("int"))
    blocks = member.groupBy("list", "band").agg(F.ceil(F.count(F.lit(1)) / BLOCK).cast("int").alias("blocks"))
    above = blocks.select("list", (F.col("band") - 1).alias("band"), F.col("blocks").alias("above"))
    below = blocks.select("list", (F.col("band") + 1).alias("band"), F.col("blocks").alias("below"))
    placed = (member.join(blocks, ["list", "band"]).join(above, ["list", "band"], "left").join(below, ["list", "band"], "left")
              .withColumn("block", F.pmod("key", F.col("blocks")).cast("int")))
    every = lambda n: F.when(F.coalesce(n, F.lit(0)) > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))
    tile = lambda band, one, next_band, two: F.struct(band.alias("band"), one.alias("one"), F.lit(next_band).alias("up"), two.alias("two"))
    own, block = F.col("band"), F.col("block")
    where = F.concat(
        F.transform(every(F.col("blocks")), lambda x: tile(own, F.least(block, x), 0, F.greatest(block, x))),
        F.transform(every(F.col("above")), lambda x: tile(own, block, 1, x)),
        F.transform(every(F.col("below")), lambda x: tile(own - 1, x, 1, block)))

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        told: set[tuple[int, int]] = set()
        kept: pa.Table | None = None

        def groups(rows: pa.Table, last: bool) -> Iterator[tuple[int, int]]:
            which = rows.column("number").to_numpy()
            starts = np.flatnonzero(np.concatenate(([True], which[1:] != which[:-1]))).tolist() if len(which) else []
            yield from zip(starts, [*starts[1:], len(which)] if last else starts[1:])

        def pairs(rows: pa.Table, last: bool) -> tuple[list[tuple[int, int]], int]:
            key, n, component = (rows.column(c).to_numpy() for c in ("key", "n", "component"))
            bitmaps, found, end = rows.column("bitmap"), [], 0
            for start, end in groups(rows, last):
                maps = folded(bitmaps.slice(start, end - start).to_pylist())
                sizes, owner = n[start:end], component[start:end]
                step = max(1, 200_000 // max(1, maps.size))
                for i in range(0, len(sizes), step):  # some rows against all behind them
                    one, other = np.nonzero(np.triu(owner[i:i + step, None] != owner[None, :], i + 1))
                    one += i
                    likely = 100 * np.minimum(sizes[one], sizes[other]) >= percent * np.maximum(sizes[one], sizes[other])
                    one, other = one[likely], other[likely]
                    for p in range(0, len(one), 4096):
                        x, y = one[p:p + 4096], other[p:p + 4096]
                        fits = links(overlap_bound(maps[x], maps[y], sizes[x], sizes[y]), sizes[x], sizes[y], percent)
                        for u, v in zip(key[start + x[fits]].tolist(), key[start + y[fits]].tolist()):
                            pair = (u, v) if u < v else (v, u)
                            if pair not in told:
                                told.add(pair)
                                found.append(pair)
                if len(told) > 200_000:
                    told.clear()
            return found, end

        def table(found: list[tuple[int, int]]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found)], names=["a", "b"])

        for batch in batches:
            rows = pa.Table.from_batches([batch])
            kept = rows if kept is None else pa.concat_tables([kept, rows])
            found, end = pairs(kept, False)
            kept = kept.slice(end)
            if found:
                yield table(found)
        found = pairs(kept, True)[0] if kept is not None else []
        if found:
            yield table(found)

    spread = stored(placed.select("list", "key", "n", "component", F.explode_outer(where).alias("tile")))
    # a tile whose rows are all of one component has nothing to compare
    mixed = (spread.groupBy("list", "tile").agg(F.min("component").alias("low"), F.max("component").alias("high"),
                                                F.min("key").alias("anchor"))
             .filter("low < high").select("list", "tile", "anchor"))
    # A tile's rows come one after the other (tiles of the same number by chance are compared as one).
    # Tiles with the same smallest key, which share many pairs, meet in one task that tells a pair once.
    named = spread.join(mixed, ["list", "tile"]).select("anchor", F.xxhash64("list", "tile").alias("number"), "key", "n", "component")
    whole = stored(named).join(sets.select("key", "bitmap"), "key")
    sorted_rows = (whole.select("anchor", "number", "key", "n", "component", "bitmap")
                   .repartition("anchor").sortWithinPartitions("anchor", "number", "key"))
    return sorted_rows.mapInArrow(compare, "a long, b long").distinct()


def jaccard_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = PERCENT,
                       broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """``doc_id, n_shingles, component_id, n_links_found`` of every row.

    A document's set are the distinct 5-word shingles of its words (A-Z in lower case, separated by
    ASCII white space); a text of fewer words is one shingle, a null or blank one has none and links
    with nothing. ``component_id`` is the smallest id reachable by links, its own included;
    ``n_links_found`` counts the other different sets that were found linked with this one's set directly
    (a lower bound: links inside a component that was already known are not all looked up). Rows of
    equal sets, or that share an id and a text, are of one component. A null id stays in the
    result; it is the component of its set only if all its ids are null.
    """
    rows = docs.select(docs[id_col].cast("long").alias("doc_id"), docs[text_col].alias("text"))
    survey = stored(_survey(rows))
    found = survey.filter("shingle IS NULL")
    sets = stored(found.filter("n > 0").groupBy("key", "n").agg(F.min("doc_id").alias("class_id"), F.first("bitmap").alias("bitmap")))
    frequent = (survey.filter("shingle IS NOT NULL").groupBy("shingle").agg(F.sum("times").alias("times"))
                .orderBy(F.desc("times"), "shingle").limit(FREQUENT).select("shingle").toPandas())
    last = frequent["shingle"].to_numpy(dtype=np.int64)[::-1].copy().view(np.uint64)
    candidates = stored(_candidates(_postings(rows, last, percent), percent))
    pairs = candidates.filter("list IS NULL").select("a", "b").distinct()
    first = stored(_linked(stored(_possible(pairs, sets, percent)), rows, sets, percent, broadcast_rows))
    labels = components(first)
    members = candidates.filter("list IS NOT NULL").select("list", F.col("a").alias("key"))
    # of lists with the same members one is enough
    alike = (members.groupBy("list").agg(F.count(F.lit(1)).alias("size"), F.sum(F.xxhash64("key").cast("decimal(20,0)")).alias("sum"),
                                         F.bit_xor(F.xxhash64("key", F.lit(1))).alias("mark"))
             .groupBy("size", "sum", "mark").agg(F.min("list").alias("list")))
    members = (members.join(alike.select("list"), "list", "left_semi").join(labels.withColumnRenamed("id", "key"), "key", "left")
               .select("list", "key", F.coalesce("label", "key").alias("component")))
    second = _linked(stored(_tiles(stored(members), sets, percent)), rows, sets, percent, broadcast_rows)
    edges = stored(first.unionByName(second).distinct())
    labels = components(edges)
    ends = edges.select(F.col("a").alias("key")).unionByName(edges.select(F.col("b").alias("key")))
    degree = ends.groupBy("key").agg(F.count(F.lit(1)).alias("n_links_found"))
    # the label of a component is a set's key: its smallest class id is what the result shows
    classes = (sets.select("key", "class_id").join(labels.withColumnRenamed("id", "key"), "key", "left")
               .withColumn("label", F.coalesce("label", "key")))
    smallest = classes.groupBy("label").agg(F.min("class_id").alias("component_id"))
    named = classes.join(smallest, "label").join(degree, "key", "left").select("key", "component_id", "n_links_found")
    return (found.select("doc_id", "n", "key").join(named, "key", "left")
            .select(F.col("doc_id").alias(id_col), F.col("n").alias("n_shingles"),
                    F.coalesce("component_id", "doc_id").alias("component_id"), F.coalesce("n_links_found", F.lit(0)).alias("n_links_found")))
