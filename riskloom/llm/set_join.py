"""Exact Jaccard join of word n-gram sets by universe partitioning and allocated pigeonholes.

Two sets of s and t shingles with 100 * common >= p * union differ in at most ``(s + t)(100 - p) / (100 + p)`` shingles.
Sizes are cut into bands such that a set links only inside its band and the next lower one. A band has one partition of
the universe: a shingle's hash names its segment, so that of the segments of two sets that link, some differ little:
if segment i may differ in v_i shingles and the v_i + 1 add up to more than the sets differ in, one segment keeps to its v_i.

1. A set is indexed under each of its segments. It probes its own band and, where sizes allow, the lower one.
2. Allocation by cost: what a probed segment costs is the number of other sets with the same segment. A probe needs the
   number of allowed differences and one; it takes that many of its cheapest segments at v = 0 (equal segments). While
   the dearest of them costs more than raising another one to v = 1 (``MOVED`` for every key that has to travel), that
   one is raised and the dearest dropped, v = -1: segments that crowds share, empty ones among them, are not probed.
3. A raised segment meets those with one shingle less by the keys of its one-deletion neighbours, and those with one
   more by the neighbours of indexed segments. A filter of bits over the raised keys keeps other neighbours at home.
4. Equal sets are one class from the start, so a link is between classes. Per key one member, the hub, is paired with all
   others. Keys that then hold several components go on: members outside the largest become hubs, about ``HUBS`` a key
   at first, four times as many each round, until every probe and every indexed set of a key that end in different
   components were compared. This goes in blocks of about ``BLOCK`` by ``BLOCK`` over salted keys.
5. Every set has a row of bits, each the parity of the hashes that fall on it. Two rows differ in no more bits than their
   sets in shingles, so pairs that differ in more bits are out; all others are verified on the full sets.

Defined results: null, empty and blank texts have an empty set and link with nothing; fewer words than a shingle make
one shingle; rows with a null id link with nothing and have themselves (null) as component; rows that share an id are
one document with several sets, all linked; ids may have any type that can be ordered; extra columns are ignored. Empty
tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import words
from riskloom.llm.components import components
from riskloom.llm.ids import of_any_type
from riskloom.llm.minhash import relabelled, shingles
from riskloom.llm.scratch import Scratch
from riskloom.llm.substrings import bit_filters, passes
from riskloom.session import BROADCAST_ROWS, broadcast_if_small

SHINGLE = 3
THRESHOLD_PERCENT = 90
MOVED = 4
LEAST_RAISED = 4
HOT = 1000
HUBS = 256
BLOCK = 256
FILTER_BITS = 1 << 29
BITS_PER_KEY = 16
_SPREAD, _PARITY, _WIDE = np.uint64(0x2545F4914F6CDD1D), np.uint64(0x5851F42D4C957F2D), np.uint64(0x14057B7EF767814F)


@dataclass
class Bands:
    """Sizes from ``start[b]`` to ``last[b]`` with ``parts[b]`` segments, for sets of up to ``most`` shingles."""

    percent: int
    most: int

    def __post_init__(self) -> None:
        p = self.percent
        starts = [-(-p // (100 - p))] if p < 100 else []
        while starts and starts[-1] <= self.most:
            starts.append(-(-100 * starts[-1] // p))
        self.start = np.array(starts[:-1], np.int64)
        self.last = np.array(starts[1:], np.int64) - 1
        self.parts = self.allowed(100 * self.last // p, self.last) + 1

    def allowed(self, s, t):
        """In how many shingles sets of these sizes may differ."""
        return (s + t) * (100 - self.percent) // (100 + self.percent)

    def of(self, sizes: np.ndarray, lower: bool = False) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Per set its band, the band's segments and how many of them a probe needs; none where no link can be."""
        band = np.searchsorted(self.start, sizes, "right") - 1 - int(lower)
        there = (band >= 0) & (sizes > 0)
        last = self.last[np.maximum(band, 0)] if len(self.last) else np.zeros_like(sizes)
        if lower:
            there &= -(-self.percent * sizes // 100) <= last
        parts = np.where(there, self.parts[np.maximum(band, 0)] if len(self.parts) else 0, 0)
        return band, parts, np.where(there, self.allowed(sizes, np.minimum(sizes, last)) + 1, 0)


@dataclass
class Segments:
    """The segments of some sets in a row: ``first[r]`` is the first of set r; ``cell`` the segment of each shingle."""

    first: np.ndarray
    cell: np.ndarray
    spread: np.ndarray
    size: np.ndarray
    sum: np.ndarray
    tag: np.ndarray

    @classmethod
    def of(cls, row: np.ndarray, h: np.ndarray, band: np.ndarray, parts: np.ndarray) -> Segments:
        """Of shingle hashes ordered by set and hash; sets without parts have no segment."""
        first = np.concatenate([[0], np.cumsum(parts)])
        use = parts[row] > 0
        row, h = row[use], h[use]
        cell = first[row] + ((h >> np.uint64(32)) * parts[row].astype(np.uint64) >> np.uint64(32)).astype(np.int64)
        edge = np.searchsorted(cell, np.arange(first[-1] + 1))
        spread = words.mix(h + _SPREAD)
        upto = np.concatenate([np.zeros(1, np.uint64), np.cumsum(spread, dtype=np.uint64)])
        number = np.arange(first[-1]) - np.repeat(first[:-1], parts)
        tag = words.mix((np.repeat(band, parts).astype(np.uint64) << np.uint64(40)) + number.astype(np.uint64) + np.uint64(1))
        return cls(first, cell, spread, np.diff(edge), upto[edge[1:]] - upto[edge[:-1]], tag)

    @property
    def keys(self) -> np.ndarray:
        return words.mix(self.sum ^ self.tag)

    def neighbours(self) -> np.ndarray:
        """The key of each shingle's segment without that shingle."""
        return words.mix((self.sum[self.cell] - self.spread) ^ self.tag[self.cell])


def wide(keys: np.ndarray) -> np.ndarray:
    """Keys under which raised segments meet one-deletion neighbours of indexed ones."""
    return words.mix(keys + _WIDE)


def parity(row: np.ndarray, h: np.ndarray, parts: np.ndarray) -> list[bytes]:
    """Per set the parities of the hashes on each of some bits, eight or more a segment."""
    size = np.where(parts > 0, 1 << np.ceil(np.log2(np.maximum(8 * parts, 64))).astype(np.int64), 0)
    first = np.concatenate([[0], np.cumsum(size)])
    use = size[row] > 0
    row, h = row[use], words.mix(h[use] + _PARITY)
    odd = np.bincount(first[row] + (h & (size[row] - 1).astype(np.uint64)).astype(np.int64), minlength=first[-1]) & 1
    packed = np.packbits(odd.astype(bool)).tobytes()
    return [packed[a // 8 : b // 8] for a, b in zip(first[:-1].tolist(), first[1:].tolist())]


def folded(rows: list[bytes], width: int) -> np.ndarray:
    """Parities as rows of 64-bit numbers, the longer ones folded to ``width`` bytes."""
    out = np.zeros((len(rows), width // 8), np.uint64)
    for i, row in enumerate(rows):
        out[i] = np.bitwise_xor.reduce(np.frombuffer(row, np.uint64).reshape(-1, width // 8), axis=0)
    return out


def names(row: np.ndarray, h: np.ndarray, sizes: np.ndarray) -> pa.Array:
    """128 bits that name each set."""
    edge = np.concatenate([[0], np.cumsum(sizes)])
    sums = [np.concatenate([np.zeros(1, np.uint64), np.cumsum(x, dtype=np.uint64)]) for x in (h, words.mix(h + np.uint64(1)))]
    both = np.stack([words.mix(s[edge[1:]] - s[edge[:-1]] + sizes.astype(np.uint64)) for s in sums], axis=1)
    return pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(sizes), [None, pa.py_buffer(both.tobytes())]).cast(pa.binary())


def _lists(values: np.ndarray, first: np.ndarray) -> pa.Array:
    return pa.ListArray.from_arrays(pa.array(first.astype(np.int32)), pa.array(values.view(np.int64)))


def _sets(batch: pa.RecordBatch, k: int) -> Iterator[tuple[int, int, np.ndarray, np.ndarray, np.ndarray]]:
    for piece in words.pieces(batch["text"], words.SOLID, lower=True):
        row, h = shingles(piece, k)
        yield piece.lo, piece.hi - piece.lo, row, h, np.bincount(row, minlength=piece.hi - piece.lo)


def sketch(docs: DataFrame, k: int, percent: int) -> DataFrame:
    """doc_id, name, n, the keys of the set's own and its lower band, and its parities, for every row."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo, n, row, h, sizes in _sets(batch, k):
                bands = Bands(percent, int(sizes.max(initial=0)))
                band, parts, _ = bands.of(sizes)
                own = Segments.of(row, h, band, parts)
                low = Segments.of(row, h, *bands.of(sizes, lower=True)[:2])
                yield pa.RecordBatch.from_arrays([
                    batch["doc_id"].slice(lo, n), names(row, h, sizes), pa.array(sizes.astype(np.int64)),
                    _lists(own.keys, own.first), _lists(low.keys, low.first), pa.array(parity(row, h, parts), pa.binary()),
                ], ["doc_id", "name", "n", "own", "low", "parity"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {kind}, name binary, n bigint, own array<bigint>, low array<bigint>, parity binary"
    return docs.select("doc_id", F.col("text").cast("string")).mapInArrow(step, schema)


def full_sets(docs: DataFrame, k: int) -> DataFrame:
    """name and set, as sorted 64-bit numbers in bytes, of every row."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, row, h, sizes in _sets(batch, k):
                edge = np.concatenate([[0], np.cumsum(sizes)]).tolist()
                yield pa.RecordBatch.from_arrays([names(row, h, sizes), pa.array([h[a:b].tobytes() for a, b in zip(edge[:-1], edge[1:])], pa.binary())], ["name", "shingles"])

    return docs.select(F.col("text").cast("string")).mapInArrow(step, "name binary, shingles binary")


def with_keys(rows: DataFrame, keys: DataFrame) -> DataFrame:
    """``rows`` with the columns of ``keys`` (one row a key, with its ``size``); rows of hot keys stay where they are."""
    hot = keys.where(F.col("size") > HOT)
    count = hot.count()
    if not 0 < count <= BROADCAST_ROWS:
        return rows.join(keys, "key")
    hot = F.broadcast(hot)
    cold = rows.join(hot.select("key"), "key", "left_anti").join(keys.where(F.col("size") <= HOT), "key")
    return rows.join(hot, "key").unionByName(cold)


def filter_of(spark, keys: DataFrame):
    """A filter of bits over the column ``key``; past ``FILTER_BITS`` more passes, and results stay the same."""
    bits = min(FILTER_BITS, BITS_PER_KEY * max(1, keys.count()))
    return spark.sparkContext.broadcast(bit_filters(keys.select(F.col("key").alias("hash"), F.lit(False).alias("hot")), bits)[0])


def keys_that_pass(heads: DataFrame, filter_, own_only: bool) -> DataFrame:
    """key, name, own and segment of the keys of all sets that pass the filter."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for column in ("own",) if own_only else ("own", "low"):
                keys = batch[column]
                flat, count = np.asarray(keys.flatten()), np.asarray(keys.value_lengths()).astype(np.int64)
                row = np.repeat(np.arange(len(count)), count)
                number = np.arange(len(flat)) - np.repeat(np.cumsum(count) - count, count)
                pick = passes(filter_.value, flat.view(np.uint64))
                yield pa.RecordBatch.from_arrays([
                    pa.array(flat[pick]), batch["name"].take(pa.array(row[pick])), pa.array(np.full(int(pick.sum()), column == "own")), pa.array(number[pick]),
                ], ["key", "name", "own", "segment"])

    return heads.select("name", "own", "low").mapInArrow(step, "key bigint, name binary, own boolean, segment bigint")


def allocate(cost: np.ndarray, size: np.ndarray, need: int, moved: int = MOVED) -> tuple[np.ndarray, np.ndarray]:
    """The segments to probe, and those of them that are raised: with each raised one twice, they are ``need``."""
    order = np.argsort(cost, kind="stable")[:need]
    if not len(order) or cost[order[-1]] <= 0:
        return order, order[:0]
    price = np.where(size[order] >= LEAST_RAISED, moved * (size[order] + 1) + cost[order], np.inf)
    by_price = np.argsort(price, kind="stable")
    dropped, raised, dearest = np.zeros(len(order), bool), [], len(order) - 1
    for at in by_price.tolist():
        while dearest >= 0 and (dropped[dearest] or dearest in raised):
            dearest -= 1
        if dropped[at] or at == dearest or dearest < 0 or not cost[order[dearest]] > price[at]:
            break
        dropped[dearest] = True
        raised.append(at)
    return order[~dropped], order[np.array(raised, np.int64)]


def probes(hits: DataFrame, sets: DataFrame, percent: int, moved: int) -> DataFrame:
    """key, name and whether raised: what the sets with hits are looked up under."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = [np.frombuffer(v.as_buffer(), np.uint64) for v in batch["shingles"]]
            sizes = np.array([len(t) for t in texts], np.int64)
            row, h = np.repeat(np.arange(len(texts)), sizes), np.concatenate([np.zeros(0, np.uint64), *texts])
            bands = Bands(percent, int(sizes.max(initial=0)))
            found = batch["hits"].flatten()
            of, own, number, others = (np.asarray(c) for c in (batch["hits"].value_parent_indices(), *(found.field(f) for f in ("own", "segment", "others"))))
            for lower in (False, True):
                band, parts, need = bands.of(sizes, lower)
                seg = Segments.of(row, h, band, parts)
                cost = np.zeros(seg.first[-1], np.int64)
                pick = own != lower
                cost[seg.first[of[pick]] + number[pick]] = others[pick]
                raised_at, probed = np.zeros(len(cost), bool), np.zeros(len(cost), bool)
                for r in np.flatnonzero(need).tolist():
                    a, b = seg.first[r], seg.first[r + 1]
                    chosen, raised = allocate(cost[a:b], seg.size[a:b], int(need[r]), moved)
                    probed[a + chosen], raised_at[a + raised] = True, True
                owner = np.repeat(np.arange(len(texts)), parts)
                exact, up = np.flatnonzero(probed & (cost > 0)), np.flatnonzero(raised_at)
                less = np.flatnonzero(raised_at[seg.cell])
                keys = np.concatenate([seg.keys[exact], wide(seg.keys[up]), seg.neighbours()[less]])
                rows = np.concatenate([owner[exact], owner[up], owner[seg.cell[less]]])
                yield pa.RecordBatch.from_arrays(
                    [pa.array(keys.view(np.int64)), batch["name"].take(pa.array(rows)), pa.array(np.arange(len(keys)) >= len(exact))], ["key", "name", "raised"])

    of_set = hits.groupBy("name").agg(F.collect_list(F.struct("own", "segment", "others")).alias("hits"))
    return of_set.join(sets, "name").select("name", "hits", "shingles").mapInArrow(step, "key bigint, name binary, raised boolean")


def indexed_neighbours(docs: DataFrame, filter_, k: int, percent: int) -> DataFrame:
    """key and name of the one-deletion neighbours of all segments that pass the filter."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, row, h, sizes in _sets(batch, k):
                band, parts, _ = Bands(percent, int(sizes.max(initial=0))).of(sizes)
                seg = Segments.of(row, h, band, parts)
                keys = wide(seg.neighbours())
                pick = np.flatnonzero(passes(filter_.value, keys))
                owner = np.repeat(np.arange(len(sizes)), parts)[seg.cell[pick]]
                yield pa.RecordBatch.from_arrays([pa.array(keys[pick].view(np.int64)), names(row, h, sizes).take(pa.array(owner))], ["key", "name"])

    return docs.select(F.col("text").cast("string")).mapInArrow(step, "key bigint, name binary")


def near_enough(n, m, apart, percent: int):
    """Whether sets of these sizes that differ in ``apart`` shingles or more may link."""
    return (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (apart <= (n + m) * (100 - percent) // (100 + percent))


def possible(pairs: DataFrame, facts: DataFrame, percent: int) -> DataFrame:
    """The pairs whose sizes and parities allow a link."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            n, m = np.asarray(batch["n_a"]), np.asarray(batch["n_b"])
            apart = np.zeros(len(n), np.int64)
            for i, (x, y) in enumerate(zip(batch["parity_a"], batch["parity_b"])):
                x, y = x.as_py(), y.as_py()
                width = min(len(x), len(y))
                apart[i] = np.bitwise_count(folded([x], width) ^ folded([y], width)).sum() if width else n[i] + m[i]
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(near_enough(n, m, apart, percent)))

    sides = [facts.select(F.col("name").alias(c), F.col("n").alias(f"n_{c}"), F.col("parity").alias(f"parity_{c}")) for c in ("a", "b")]
    return pairs.join(sides[0], "a").join(sides[1], "b").mapInArrow(step, "a binary, b binary")


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs whose full sets are similar enough."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keep = []
            for x, y in zip(batch["x"], batch["y"]):
                x, y = (np.frombuffer(v.as_buffer(), np.uint64) for v in (x, y))
                both = len(x) + len(y) - len(np.union1d(x, y))
                keep.append(both > 0 and 100 * both >= percent * (len(x) + len(y) - both))
            yield pa.RecordBatch.from_arrays([batch["a"], batch["b"]], ["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left, right = (sets.select(F.col("name").alias(c), F.col("shingles").alias(s)) for c, s in (("a", "x"), ("b", "y")))
    return pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y").mapInArrow(step, "a binary, b binary")


def pairs_of(first: str, second: str) -> list[Column]:
    return [F.least(first, second).alias("a"), F.greatest(first, second).alias("b")]


def star_pairs(buckets: DataFrame) -> DataFrame:
    """Each key's hub with its members, where one is indexed and the other probes."""
    rank = 3 - 2 * F.col("indexed").cast("int") - F.col("probing").cast("int")
    hubs = buckets.groupBy("key").agg(F.count("*").alias("size"), F.min(F.struct(rank.alias("rank"), "name")).alias("hub"))
    hubs = hubs.select("key", "size", F.col("hub.name").alias("hub"), (F.col("hub.rank") != 1).alias("hub_probing"))
    meets = F.col("probing") | (F.col("hub_probing") & F.col("indexed"))
    return with_keys(buckets, hubs).where((F.col("name") != F.col("hub")) & meets).select(*pairs_of("name", "hub")).distinct()


def block_pairs(hubs: DataFrame, others: DataFrame, percent: int) -> DataFrame:
    """Pairs of a hub and another member of different components that meet and that sizes and parities allow."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i in range(batch.num_rows):
                sides = [batch[c][i].values for c in ("hubs", "others")]
                comps = pa.concat_arrays([s.field("comp") for s in sides]).dictionary_encode().indices.to_numpy()
                rows = [s.field("parity").to_pylist() for s in sides]
                width = min(len(r) for side in rows for r in side)
                bits = [folded(side, width) for side in rows]
                (n, hub_in, hub_out), (m, in_, out) = ([np.asarray(s.field(c)) if c == "n" else np.asarray(s.field(c).cast(pa.int8())) > 0 for c in ("n", "indexed", "probing")] for s in sides)
                comp, comp_m = comps[: len(n)], comps[len(n) :]
                left, right = [], []
                for j in range(len(n)):
                    at = np.flatnonzero((comp_m != comp[j]) & ((out & hub_in[j]) | (in_ & hub_out[j])))
                    apart = np.bitwise_count(bits[1][at] ^ bits[0][j]).sum(axis=1, dtype=np.int64)
                    at = at[near_enough(n[j], m[at], apart, percent)]
                    left.append(np.full(len(at), j))
                    right.append(at)
                pairs = [s.field("name").take(pa.array(np.concatenate(x).astype(np.int64))) for s, x in zip(sides, (left, right))]
                yield pa.RecordBatch.from_arrays(pairs, ["x", "y"])

    joined = hubs.select("key", "i", "j", "hubs").join(others.select("key", "i", "j", "others"), ["key", "i", "j"]).select("hubs", "others")
    return joined.mapInArrow(step, "x binary, y binary").select(*pairs_of("x", "y")).distinct()


def blocks(rows: DataFrame, facts: DataFrame, name: str, block: str, parts: str) -> DataFrame:
    """The members of a key in blocks, one row each, dealt by hash over as many as ``parts`` says."""
    fact = F.struct("name", "comp", "indexed", "probing", "n", "parity")
    dealt = rows.withColumn(block, F.pmod(F.xxhash64("name"), F.col(parts)))
    return dealt.join(facts, "name").groupBy("key", block, "across", "down").agg(F.collect_list(fact).alias(name))


def upto(number: str) -> Column:
    return F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(number) - 1))


class Join:
    """One run: the tables that its steps share."""

    def __init__(self, docs: DataFrame, k: int, percent: int, moved: int):
        self.spark, self.k, self.percent, self.moved = docs.sparkSession, k, percent, moved
        self.docs = docs.select("doc_id", "text").where("doc_id IS NOT NULL")
        self.scratch = Scratch(self.spark)
        self.rest = self.scratch.rest
        self.sketched = self.rest(sketch(docs, k, percent), "sketches")
        usable = self.sketched.where("n > 0 AND doc_id IS NOT NULL")
        heads = usable.groupBy("name").agg(F.count("*").alias("rows"), F.min("doc_id").alias("first"), F.min_by(F.struct("n", "own", "low", "parity"), "doc_id").alias("s"))
        self.heads = self.rest(heads.select("name", "rows", "first", "s.*"), "heads")
        self.facts = self.heads.select("name", "n", "parity")
        shared = usable.groupBy("doc_id").agg(F.min("name").alias("a"), F.max("name").alias("z")).where("a < z").select(F.col("doc_id").alias("of"), "a")
        shared = self.rest(shared, "shared-ids")
        self.same = usable.join(broadcast_if_small(shared, shared.count()), F.col("doc_id") == F.col("of")).select("a", F.col("name").alias("b")).where("a <> b")
        self.sets = self.rest(self.sets_of(self.heads.where("false").select("name")), "sets")

    def sets_of(self, wanted: DataFrame) -> DataFrame:
        """The full sets of these names, from the texts of their documents."""
        wanted = self.rest(wanted, "wanted")
        count = wanted.count()
        ids = self.heads.join(broadcast_if_small(wanted, count), "name", "left_semi").select(F.col("first").alias("of")).distinct()
        chosen = self.docs.join(broadcast_if_small(ids, count), F.col("doc_id") == F.col("of"), "left_semi")
        return full_sets(chosen, self.k).join(broadcast_if_small(wanted, count), "name", "left_semi").dropDuplicates(["name"])

    def add_sets(self, wanted: DataFrame) -> None:
        """Make sure that these names have their sets at rest."""
        missing = self.rest(wanted.distinct().join(self.sets, "name", "left_anti"), "missing")
        if not missing.isEmpty():
            self.sets = self.rest(self.sets.unionByName(self.sets_of(missing)), "sets")

    def buckets(self) -> DataFrame:
        """key, name, indexed and probing for all keys under which a probe meets another indexed set."""
        each = self.heads.select(F.explode("own").alias("key"), F.lit(1).alias("own")).unionByName(self.heads.select(F.explode("low").alias("key"), F.lit(0).alias("own")))
        counts = each.groupBy("key").agg(F.count("*").alias("size"), F.sum("own").alias("in_index")).where("size > 1 AND in_index > 0")
        counts = self.rest(counts, "keys")
        hits = with_keys(keys_that_pass(self.heads, filter_of(self.spark, counts), False), counts)
        hits = self.rest(hits.select("key", "name", "own", "segment", (F.col("in_index") - F.col("own").cast("int")).alias("others")), "hits")
        met = hits.where("others > 0")
        self.add_sets(met.select("name"))
        probing = self.rest(probes(met, self.sets, self.percent, self.moved), "probes")
        indexed = hits.where("own").select("key", "name")
        raised = probing.where("raised").select("key")
        if not raised.isEmpty():
            filter_ = filter_of(self.spark, raised)
            more = keys_that_pass(self.heads, filter_, True).select("key", "name").unionByName(indexed_neighbours(self.docs, filter_, self.k, self.percent))
            indexed = indexed.unionByName(more)
        yes, no = F.lit(True), F.lit(False)
        entries = indexed.select("key", "name", yes.alias("indexed"), no.alias("probing")).unionByName(probing.select("key", "name", no.alias("indexed"), yes.alias("probing")))
        entries = self.rest(entries.groupBy("key", "name").agg(F.max("indexed").alias("indexed"), F.max("probing").alias("probing")), "entries")
        useful = entries.groupBy("key").agg(F.count("*").alias("size"), F.max("indexed").alias("i"), F.max("probing").alias("p")).where("size > 1 AND i AND p").select("key", "size")
        found = self.rest(with_keys(entries, self.rest(useful, "keys")).drop("size"), "buckets")
        self.scratch.drop("hits", "probes", "entries", "keys")
        return found

    def links(self, pairs: DataFrame) -> DataFrame:
        """Those of the pairs that link."""
        able = self.rest(possible(pairs, self.facts, self.percent), "able")
        self.add_sets(able.select(F.col("a").alias("name")).unionByName(able.select(F.col("b").alias("name"))))
        return self.rest(verified(able, self.sets, self.percent), "links")

    def labels(self) -> DataFrame:
        """node and component of every set that links with another one."""
        buckets = self.buckets()
        tested = self.rest(star_pairs(buckets), "tested-0")
        labels = self.rest(components(self.links(tested).unionByName(self.same)), "labels")
        live = buckets.withColumn("hubbed", F.lit(False))
        rounds, count = 0, HUBS
        while True:
            comp = labels.select(F.col("node").alias("name"), "component")
            placed = self.rest(live.join(comp, "name", "left").withColumn("comp", F.coalesce("component", "name")).drop("component"), "placed")
            of_comp = placed.groupBy("key", "comp").agg(F.count("*").alias("c"), F.count_if(~F.col("hubbed")).alias("fresh"))
            mixed = of_comp.groupBy("key").agg(
                F.sum("c").alias("size"), F.sum("fresh").alias("fresh"), F.count("*").alias("comps"), F.max(F.struct("c", "comp", "fresh")).alias("most"))
            mixed = mixed.select("key", "size", F.col("most.comp").alias("main"), (F.col("fresh") - F.col("most.fresh")).alias("waiting"), "comps")
            mixed = self.rest(mixed.where("comps > 1 AND waiting > 0").drop("comps"), "mixed")
            if mixed.isEmpty():
                return labels
            drawn = F.pmod(F.xxhash64("name", "key"), F.lit(1 << 30)) / (1 << 30) < F.lit(float(count)) / F.col("waiting")
            hub = ~F.col("hubbed") & (F.col("comp") != F.col("main")) & drawn
            live = self.rest(with_keys(placed, mixed).withColumn("hub", hub).drop("main", "waiting"), "live")
            hubs = live.where("hub")
            parts = lambda n: F.ceil(F.col(n) / BLOCK)
            crowds = hubs.groupBy("key").agg(F.max("size").alias("size"), F.count("*").alias("hubs")).select("key", "size", parts("hubs").alias("across"), parts("size").alias("down"))
            crowds = self.rest(crowds, "crowds")
            left = blocks(with_keys(hubs.drop("size"), crowds), self.facts, "hubs", "i", "across").select("*", upto("down").alias("j"))
            right = blocks(with_keys(live.drop("size"), crowds), self.facts, "others", "j", "down").select("*", upto("across").alias("i"))
            near = block_pairs(left, right, self.percent)
            rounds += 1
            pairs = self.rest(near.join(tested, ["a", "b"], "left_anti"), f"tested-{rounds}")
            tested = tested.unionByName(pairs)
            links = self.links(pairs)
            if not links.isEmpty():
                labels = self.rest(relabelled(labels, links), "labels")
            live = live.select("key", "name", "indexed", "probing", (F.col("hubbed") | F.col("hub")).alias("hubbed"))
            count *= 4

    def groups(self) -> DataFrame:
        labels = self.labels()
        of_name = self.heads.join(labels.withColumnRenamed("node", "name"), "name", "left").select("name", "rows", "first", F.coalesce("component", "name").alias("comp"))
        of_name = self.rest(of_name, "of-name")
        least = self.rest(of_name.groupBy("comp").agg(F.count("*").alias("sets"), F.min("first").alias("component_id")).where("sets > 1").select("comp", "component_id"), "least")
        known = of_name.join(broadcast_if_small(least, least.count()), "comp", "left").select("name", "rows", F.coalesce("component_id", "first").alias("component_id"), "first")
        known = self.rest(known.where((F.col("rows") > 1) | (F.col("component_id") != F.col("first"))).select(F.col("name").alias("of"), "component_id"), "known")
        self.scratch.drop_all_but("sketches", "known")
        found = self.sketched.join(broadcast_if_small(known, known.count()), F.col("doc_id").isNotNull() & (F.col("name") == F.col("of")), "left")
        return found.select("doc_id", F.col("n").alias("n_shingles"), F.coalesce("component_id", "doc_id").alias("component_id"))


@of_any_type("doc_id", "component_id")
def similar_groups(docs: DataFrame, k: int = SHINGLE, percent: int = THRESHOLD_PERCENT, moved: int = MOVED) -> DataFrame:
    """doc_id, n_shingles and component_id (the smallest id reachable by links) for every row."""
    return Join(docs, k, percent, moved).groups()
