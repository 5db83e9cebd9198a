"""Near-duplicates by one-permutation MinHash with optimal densification and star-shaped candidates.

A document's set holds the 64-bit hashes of its distinct word shingles. The hash range is cut into ``BANDS * ROWS``
bins; one pass keeps the smallest hash of each bin, and an empty bin takes the value of a full one drawn by a
hash of (bin, attempt), the same for all documents. Each band of ``ROWS`` bins is a bucket key.

Documents with equal sets form a class, and only its smallest id goes on. In each bucket two hubs, the smallest id and
the one nearest to the bucket key by exclusive or, are paired with every member, so pairs grow with members and not with
their square; hubs differ from bucket to bucket, so a group is tied together through many of its members. In further
rounds, in buckets that still hold several components, members outside the largest become hubs, ``MORE_HUBS`` a bucket at
first and four times as many each round, until none is left. So every two members of a bucket that end in different
components were compared. These rounds go block by block over salted keys: ``CELLS`` counts of a set's hashes bound
what two sets can share, so that only pairs that can reach the threshold leave a block, in the least of their common
buckets. Every pair that does is confirmed on the full sets.

Defined results: null, empty and blank texts have an empty set and link with nothing; fewer words than a shingle make
one shingle; rows with a null id link with nothing and have themselves (null) as component; rows that share an id are
one document with several sets, all linked; ids of any type that has an order; extra columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from riskloom.llm import words
from riskloom.llm.components import components
from riskloom.llm.ids import of_any_type
from riskloom.session import at_rest, broadcast_if_small

SHINGLE = 5
THRESHOLD_PERCENT = 80
BANDS, ROWS = 32, 4
MORE_HUBS = 256
CELLS = 256
BLOCK = 256


def shingles(piece: words.Piece, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, hash) of all distinct shingles of a piece, in order."""
    at, h = piece.grams(k)
    row = piece.row[at]
    counts = piece.counts
    short = np.flatnonzero((counts > 0) & (counts < k))
    if len(short):
        whole = np.array([words.mix(np.bitwise_xor.reduce(words.mix(piece.hash[a:b] + np.arange(b - a, dtype=np.uint64)))[None])[0]
                          for a, b in zip(piece.first[short], piece.first[short + 1])], np.uint64)
        row, h = np.concatenate([row, short]), np.concatenate([h, whole])
    order = np.lexsort((h, row))
    row, h = row[order], h[order]
    new = np.ones(len(h), bool)
    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
    return row[new], h[new]


def densified(row: np.ndarray, h: np.ndarray, n: int, bins: int) -> np.ndarray:
    """``n`` x ``bins`` smallest hashes per bin, empty bins filled from drawn full ones; rows without a shingle stay empty."""
    bin_ = ((h >> np.uint64(32)) * np.uint64(bins) >> np.uint64(32)).astype(np.int64)
    cell = row * bins + bin_
    first = np.ones(len(cell), bool)
    first[1:] = cell[1:] != cell[:-1]
    values = np.zeros(n * bins, np.uint64)
    full = np.zeros(n * bins, bool)
    values[cell[first]], full[cell[first]] = h[first], True
    values, full = values.reshape(n, bins), full.reshape(n, bins)
    some = full.any(axis=1)
    open_row, open_bin = np.nonzero(~full & some[:, None])
    attempt = np.uint64(0)
    while len(open_row):
        attempt += np.uint64(1)
        draw = (words.mix(open_bin.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + attempt) % np.uint64(bins)).astype(np.int64)
        hit = full[open_row, draw]
        values[open_row[hit], open_bin[hit]] = values[open_row[hit], draw[hit]]
        open_row, open_bin = open_row[~hit], open_bin[~hit]
    return values


def band_keys(values: np.ndarray, bands: int, rows: int) -> np.ndarray:
    keys = np.repeat(np.arange(bands, dtype=np.uint64)[None, :], len(values), axis=0)
    for r in range(rows):
        keys = words.mix(keys * np.uint64(0xD6E8FEB86659FD93) + values[:, r::rows][:, :bands])
    return keys


def cells(row: np.ndarray, h: np.ndarray, n: int) -> list[bytes]:
    """Per row, how many of its hashes fall into each of ``CELLS`` cells; 255 stands for that and more."""
    counts = np.bincount(row * CELLS + (h % np.uint64(CELLS)).astype(np.int64), minlength=n * CELLS)
    return [x.tobytes() for x in np.minimum(counts, 255).astype(np.uint8).reshape(n, CELLS)]


def sketch(docs: DataFrame, k: int, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n (set size), set_a and set_b (two sums that name the set) and the band keys of every row."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch["text"], words.SOLID, lower=True):
                n = piece.hi - piece.lo
                row, h = shingles(piece, k)
                sizes = np.bincount(row, minlength=n)
                edges = np.concatenate([[0], np.cumsum(sizes)])
                sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (h, words.mix(h + np.uint64(1)))]
                a, b = ((s[edges[1:]] - s[edges[:-1]]).view(np.int64) for s in sums)
                keys = band_keys(densified(row, h, n, bands * rows), bands, rows).view(np.int64)
                ends = np.concatenate([[0], np.cumsum(np.where(sizes > 0, bands, 0))]).astype(np.int32)
                lists = pa.ListArray.from_arrays(pa.array(ends), pa.array(keys[sizes > 0].ravel()))
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(piece.lo, n), pa.array(sizes.astype(np.int64)), pa.array(a), pa.array(b), lists, pa.array(cells(row, h, n), pa.binary())],
                    ["doc_id", "n", "set_a", "set_b", "bands", "cells"],
                )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(step, "doc_id long, n long, set_a long, set_b long, bands array<long>, cells binary")


def shingle_sets(docs: DataFrame, k: int) -> DataFrame:
    """doc_id and its set as sorted 64-bit numbers in bytes."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch["text"], words.SOLID, lower=True):
                n = piece.hi - piece.lo
                row, h = shingles(piece, k)
                edges = np.concatenate([[0], np.cumsum(np.bincount(row, minlength=n))])
                yield pa.RecordBatch.from_arrays(
                    [batch["doc_id"].slice(piece.lo, n), pa.array([h[s:e].tobytes() for s, e in zip(edges[:-1], edges[1:])], pa.binary())],
                    ["doc_id", "shingles"],
                )

    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(step, "doc_id long, shingles binary")


def confirm(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"]):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y)) if len(x) and len(y) else 0
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = sets.select(F.col("doc_id").alias("a"), F.col("shingles").alias("x"))
    right = sets.select(F.col("doc_id").alias("b"), F.col("shingles").alias("y"))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(step, "a long, b long").distinct()


def crowded_buckets(members: DataFrame) -> DataFrame:
    """id, key and hubbed for the members of buckets with more than one; two of them are the first hubs.

    These are the smallest id and the one nearest to the bucket key by exclusive or.
    """
    near = F.col("id").bitwiseXOR(F.col("key"))
    hubs = members.groupBy("key").agg(F.min("id").alias("low"), F.max("id").alias("high"), F.min(near).alias("near")).where("low < high")
    hubbed = (F.col("id") == F.col("low")) | (near == F.col("near"))
    return members.join(hubs, "key").select("id", "key", hubbed.alias("hubbed"))


def able(pairs: DataFrame, sizes: DataFrame, percent: int) -> DataFrame:
    """Distinct pairs (a < b) of ids whose set sizes allow a link."""
    ordered = pairs.select(F.least("id", "hub").alias("a"), F.greatest("id", "hub").alias("b")).where("a < b").distinct()
    first, second = (sizes.select(F.col("id").alias(c), F.col("n").alias(f"n_{c}")) for c in ("a", "b"))
    fits = 100 * F.least("n_a", "n_b") >= percent * F.greatest("n_a", "n_b")
    return ordered.join(first, "a").join(second, "b").where(fits).select("a", "b").distinct()


def still_apart(buckets: DataFrame, labels: DataFrame) -> DataFrame:
    """Members of buckets that hold more than one component, with that component."""
    placed = buckets.join(labels.withColumnRenamed("node", "id"), "id", "left").select("id", "key", "hubbed", F.coalesce("component", "id").alias("comp"))
    mixed = placed.groupBy("key").agg(F.min("comp").alias("low"), F.max("comp").alias("high")).where("low < high")
    return placed.join(mixed.select("key"), "key")


def next_hubs(apart: DataFrame, count: int) -> DataFrame:
    """Up to ``count`` members per bucket that were no hub and are not in the bucket's largest component, with their block."""
    sizes = apart.groupBy("key", "comp").count()
    largest = sizes.groupBy("key").agg(F.max(F.struct("count", "comp")).alias("most")).select("key", F.col("most.comp").alias("main"))
    waiting = apart.where("NOT hubbed").select("key", "id", "comp").join(largest, "key").where("comp <> main")
    place = F.row_number().over(Window.partitionBy("key").orderBy("id"))
    return waiting.withColumn("place", place).where(F.col("place") <= count).select("key", "id", "comp", F.expr(f"div(place - 1, {BLOCK})").alias("block"))


def blocks(members: DataFrame, heads: DataFrame, block: Column, name: str) -> DataFrame:
    """key, and the members of one block of that bucket as a list ``name``."""
    facts = F.struct("id", "comp", "n", "cells", "bands").alias("fact")
    placed = members.join(heads, "id").select("key", block.alias("block"), facts)
    return placed.groupBy("key", "block").agg(F.collect_list("fact").alias(name)).drop("block")


def _columns(rows: pa.StructArray) -> tuple[np.ndarray, ...]:
    """id, comp, n, cells and bands of a block."""
    numbers = [np.asarray(rows.field(c)) for c in ("id", "comp", "n")]
    counts = np.stack([np.frombuffer(v.as_buffer(), np.uint8) for v in rows.field("cells")])
    return *numbers, counts, np.asarray(rows.field("bands").flatten()).reshape(len(rows), -1)


def possible(hubs: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """a < b of the pairs of a hub and a member of another component whose sets can be similar enough.

    Of two sets that share m hashes, the sums of the smaller cell counts are m at least, so none that is similar is left out.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                hub, other = (_columns(batch[c][i].values) for c in ("hubs", "others"))
                full = (other[3] == 255).any(axis=1)
                found: list[np.ndarray] = []
                for id_, comp, n, counts, bands in zip(*hub):
                    least, most = np.minimum(n, other[2]), np.maximum(n, other[2])
                    at = np.flatnonzero((other[0] != id_) & (other[1] != comp) & (100 * least >= percent * most))
                    shared = np.minimum(counts, other[3][at]).sum(axis=1, dtype=np.int64)
                    shared = np.where(full[at] | (counts == 255).any(), least[at], np.minimum(shared, least[at]))
                    at = at[100 * shared >= percent * (n + other[2][at] - shared)]
                    if len(at):
                        common = np.where(bands == other[4][at], bands, np.iinfo(np.int64).max).min(axis=1)
                        at = at[common == batch["key"][i].as_py()]
                        found.append(np.stack([np.minimum(id_, other[0][at]), np.maximum(id_, other[0][at])]))
                if found:
                    a, b = np.concatenate(found, axis=1)
                    yield pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    # Two blocks a row: a batch of rows is bounded in bytes by Spark.
    return hubs.join(others, "key").select("key", "hubs", "others").mapInArrow(step, "a long, b long").distinct()


def relabelled(labels: DataFrame, links: DataFrame) -> DataFrame:
    """The components after more links, which join whole components: a graph of few edges."""
    of = {c: labels.select(F.col("node").alias(c), F.col("component").alias(f"c_{c}")) for c in ("a", "b")}
    edges = links.join(of["a"], "a", "left").join(of["b"], "b", "left").select(F.coalesce("c_a", "a").alias("a"), F.coalesce("c_b", "b").alias("b"))
    moved = at_rest(components(edges).select(F.col("node").alias("old"), F.col("component").alias("new")), "moved")
    known = labels.join(moved, labels["component"] == moved["old"], "left").select("node", F.coalesce("new", "component").alias("component"))
    fresh = moved.join(labels, moved["old"] == labels["node"], "left_anti").select(F.col("old").alias("node"), F.col("new").alias("component"))
    return known.unionByName(fresh)


@of_any_type("doc_id", "component_id")
def near_groups(docs: DataFrame, k: int = SHINGLE, percent: int = THRESHOLD_PERCENT, bands: int = BANDS, rows: int = ROWS) -> DataFrame:
    """doc_id, n_shingles, component_id and kept for every row."""
    sketched = at_rest(sketch(docs, k, bands, rows), "sketches")
    usable = sketched.where("n > 0 AND doc_id IS NOT NULL")
    # At rest, so that the joins below are between plain shuffles, whose hot keys adaptive execution splits.
    classes = at_rest(usable.groupBy("set_a", "set_b", "n").agg(F.min("doc_id").alias("id")), "set-classes")
    of_row = at_rest(usable.select("doc_id", "set_a", "set_b", "n").join(classes, ["set_a", "set_b", "n"]).select("doc_id", "id"), "classes")
    heads = usable.join(classes, ["set_a", "set_b", "n"]).where("doc_id = id").dropDuplicates(["doc_id", "set_a", "set_b"])
    heads = at_rest(heads.select("id", "n", "bands", "cells"), "heads")
    sizes = heads.select("id", "n")
    buckets = at_rest(crowded_buckets(heads.select("id", F.explode("bands").alias("key"))), "buckets")
    hubs = buckets.where("hubbed").select("key", F.col("id").alias("hub"))
    tested = at_rest(able(buckets.join(hubs, "key"), sizes, percent), "pairs")
    wanted = at_rest(buckets.select("id").distinct(), "wanted")
    chosen = docs.join(broadcast_if_small(wanted, wanted.count()), docs["doc_id"] == wanted["id"], "left_semi")
    sets = at_rest(shingle_sets(chosen, k), "sets")
    links = at_rest(confirm(tested, sets, percent), "links")
    same = of_row.where("doc_id <> id").select(F.col("doc_id").alias("a"), F.col("id").alias("b"))
    labels = at_rest(components(links.unionByName(same)), "components")
    count = MORE_HUBS
    while True:
        apart = at_rest(still_apart(buckets, labels), "apart")
        more = at_rest(next_hubs(apart, count), "hubs")
        if more.isEmpty():
            break
        crowds = apart.join(more.select("key").distinct(), "key").groupBy("key").agg(F.ceil(F.count("*") / BLOCK).alias("parts"))
        members = apart.join(crowds, "key").select("key", "id", "comp", F.pmod(F.xxhash64("id"), "parts").alias("block"))
        near = possible(blocks(more, heads, F.col("block"), "hubs"), blocks(members, heads, F.col("block"), "others"), percent)
        pairs = at_rest(near.join(tested, ["a", "b"], "left_anti"), "pairs")
        tested = tested.unionByName(pairs)
        links = at_rest(confirm(pairs, sets, percent), "links")
        if not links.isEmpty():
            labels = at_rest(relabelled(labels, links), "components")
        done = more.select("key", "id", F.lit(True).alias("now"))
        buckets = apart.join(done, ["key", "id"], "left").select("id", "key", (F.col("hubbed") | F.coalesce("now", F.lit(False))).alias("hubbed"))
        buckets = at_rest(buckets, "buckets")
        count *= 4
    found = sketched.join(labels, sketched["doc_id"] == labels["node"], "left")
    return found.select(
        "doc_id", F.col("n").alias("n_shingles"), F.coalesce("component", "doc_id").alias("component_id"),
    ).withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def keep_one(docs: DataFrame, **how) -> DataFrame:
    """The rows that stay, with their columns; one document of each group."""
    gone = near_groups(docs, **how).where("NOT kept").select(F.col("doc_id").alias("gone_id")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["gone_id"], "left_anti")
