"""Language-model scores by prediction by partial matching (PPM) over bytes.

A text is its lower-case words, each followed by a blank, the last by an end mark; a text without words is an end mark
alone. The model is a trie of the byte contexts of up to ``ORDER`` bytes of all training texts. A byte seen n times in
the longest context has the probability (2n - 1) / 2T, for T bytes and D distinct ones seen there; one that was not seen
pays the escape D / 2T and is looked for in the next shorter context, with the bytes of the longer one
excluded from its counts; below the empty context all bytes left are equally likely. The trie is counted by Spark (counts
of ``ORDER + 1`` bytes, merged in each task before the shuffle) and sent to the tasks in slices of at most ``NODES``
entries, cut by the last two context bytes, so that each byte is scored in one slice; shorter contexts are sums of
longer ones. Beside it, word counts give a unigram score: up to ``VOCABULARY`` words, the most frequent, are
sent to the tasks, rarer ones are joined.

Defined results: a null text has no words; a null id is as an empty one when rows are dealt to training; repeated
rows are counted and scored one by one; without any training rows every byte has 1/256 and every token 1/1.
Extra columns are ignored. Empty tables give empty results.
"""

from __future__ import annotations

import math
import uuid
from collections.abc import Iterator
from dataclasses import dataclass
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import words
from riskloom.session import at_rest

ORDER = 5
NODES = 4_000_000
VOCABULARY = 3_000_000
FLUSH = 1_000_000
PIECE = 200_000
BLANK, END = 0x20, 0x0A
GRAM, WORD = 0, 1
_END_WORD = np.uint64(0)


def held_out(fold: int, folds: int) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def byte_keys(piece: words.Piece) -> tuple[np.ndarray, np.ndarray]:
    """Each byte of the normalised texts with the ``ORDER`` before it as one number, and where each text starts."""
    counts, lengths = piece.counts, piece.end - piece.start
    sizes = np.bincount(piece.row, lengths + 1, len(counts)).astype(np.int64) + (counts == 0)
    starts = np.concatenate([[0], np.cumsum(sizes)])
    stream = np.full(starts[-1], END, np.uint8)
    if len(lengths):
        begin = starts[piece.row] + np.concatenate([[0], np.cumsum(lengths + 1)[:-1]])
        begin -= np.concatenate([[0], np.cumsum(lengths + 1)])[piece.first[piece.row]]
        shift = np.repeat(begin - piece.start, lengths)
        source = np.repeat(piece.start - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths) + np.arange(lengths.sum())
        stream[source + shift] = piece.data[source]
        last = piece.first[1:][counts > 0] - 1
        gaps = begin + lengths
        stream[gaps] = BLANK
        stream[gaps[last]] = END
    keys = np.zeros(len(stream), np.uint64)
    place = np.arange(len(stream)) - np.repeat(starts[:-1], sizes)
    for back in range(ORDER, -1, -1):
        shifted = np.full(len(stream), END, np.uint8)
        shifted[back:] = stream[: max(0, len(stream) - back)]
        keys = (keys << np.uint64(8)) | np.where(place >= back, shifted, np.uint8(END)).astype(np.uint64)
    return keys, starts


def _merged(parts: list[tuple[np.ndarray, np.ndarray]]) -> tuple[np.ndarray, np.ndarray]:
    keys, n = (np.concatenate(x) for x in zip(*parts))
    order = np.argsort(keys, kind="stable")
    keys, n = keys[order], n[order]
    first = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])) if len(keys) else np.zeros(0, np.int64)
    return keys[first], np.add.reduceat(n, first) if len(first) else n


def counts(training: DataFrame) -> DataFrame:
    """kind, key and n: byte runs and word hashes of the training texts (the end mark is word 0)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list] = [[], []]
        full = False

        def flush():
            for kind in (GRAM, WORD):
                if held[kind]:
                    keys, n = _merged(held[kind])
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), kind)), pa.array(keys.view(np.int64)), pa.array(n)], ["kind", "key", "n"])
                    held[kind] = []

        for batch in batches:
            for piece in words.pieces(batch["text"], words.SOLID, lower=True, limit=PIECE):
                for kind, keys in ((GRAM, byte_keys(piece)[0]), (WORD, np.concatenate([piece.hash, np.full(piece.hi - piece.lo, _END_WORD)]))):
                    held[kind].append(np.unique(keys, return_counts=True))
                    if sum(len(k) for k, _ in held[kind]) > FLUSH:
                        held[kind] = [_merged(held[kind])]
                        full = full or len(held[kind][0][0]) > FLUSH // 2
                if full:
                    yield from flush()
                    full = False
        yield from flush()

    found = training.select(F.col("text").cast("string")).mapInArrow(step, "kind long, key long, n long")
    return found.groupBy("kind", "key").agg(F.sum("n").alias("n"))


class HashIndex:
    """Values of keys below 2 ** 64 - 1 by open addressing, three slots for two keys."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.size = np.uint64(max(16, len(keys) * 3 // 2))
        self.keys = np.full(int(self.size), np.uint64(2**64 - 1))
        self.values = np.zeros(int(self.size), np.float32)
        for lo in range(0, len(keys), FLUSH):
            self._add(keys[lo : lo + FLUSH], values[lo : lo + FLUSH])

    def _add(self, keys: np.ndarray, values: np.ndarray) -> None:
        slot, waiting = self._first(keys), np.arange(len(keys))
        while len(waiting):
            s = slot[waiting]
            free = self.keys[s] == np.uint64(2**64 - 1)
            self.keys[s[free]] = keys[waiting[free]]
            placed = self.keys[s] == keys[waiting]
            self.values[s[placed]] = values[waiting[placed]]
            waiting = waiting[~placed]
            slot[waiting] = self._next(slot[waiting])

    def _first(self, keys: np.ndarray) -> np.ndarray:
        return (words.mix(keys) >> np.uint64(32)) * self.size >> np.uint64(32)

    def _next(self, slot: np.ndarray) -> np.ndarray:
        return np.where(slot + np.uint64(1) == self.size, np.uint64(0), slot + np.uint64(1))

    def get(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Value of each key, and the places of the keys that are not held."""
        slot = self._first(keys)
        held = self.keys[slot]
        out = self.values[slot]
        open_ = np.flatnonzero(held != keys)
        missing = []
        while len(open_):
            empty = held[open_] == np.uint64(2**64 - 1)
            missing.append(open_[empty])
            open_ = open_[~empty]
            slot[open_] = self._next(slot[open_])
            held[open_] = self.keys[slot[open_]]
            done = held[open_] == keys[open_]
            out[open_[done]] = self.values[slot[open_[done]]]
            open_ = open_[~done]
        return out, np.sort(np.concatenate(missing)) if missing else open_


@dataclass
class Level:
    """Weights 2n - 1 of one order: entries (context and byte), and per context the logs of totals and escapes.

    ``total`` and ``escape`` hold for a context reached first; ``under_total`` and ``under_escape`` for the next
    shorter context after an escape from this one, without the bytes seen here.
    """

    keys: np.ndarray
    log_n: np.ndarray
    contexts: np.ndarray
    total: np.ndarray
    escape: np.ndarray
    under_total: np.ndarray
    under_escape: np.ndarray


def _log10(x: np.ndarray) -> np.ndarray:
    return np.log10(np.maximum(x, 1).astype(np.float64))


def _kept(x: np.ndarray) -> np.ndarray:
    """As it stays in memory: seven digits, half the bytes."""
    return x.astype(np.float32)


class Ppm:
    """The trie of one slice. ``grams``: runs of ``ORDER + 1`` bytes; ``pairs``: all runs of two bytes, of every slice."""

    def __init__(self, grams: tuple[np.ndarray, np.ndarray], pairs: tuple[np.ndarray, np.ndarray]):
        tables, part = [], grams
        for k in range(ORDER, -1, -1):
            part = pairs if k == 1 else part
            part = _merged([(part[0] & np.uint64((1 << 8 * (k + 1)) - 1), part[1])])
            tables.append((part[0], 2 * part[1].astype(np.int64) - 1))
        self.levels = []
        for k, (keys, n) in enumerate(tables):
            n = n.astype(np.int64)
            contexts, first = np.unique(keys >> np.uint64(8), return_index=True)
            distinct = np.diff(np.append(first, len(keys)))
            sums = np.add.reduceat(n, first) if len(first) else n
            under_total = under_distinct = np.zeros(len(contexts))
            if k + 1 < len(tables) and len(keys):
                below, below_n = tables[k + 1]
                width = np.uint64((1 << 8 * (ORDER - k)) - 1)
                own = np.add.reduceat(below_n[np.searchsorted(below, keys & width)], first)
                up, up_first = np.unique(below >> np.uint64(8), return_index=True)
                at = np.searchsorted(up, contexts & (width >> np.uint64(8)))
                under_total = np.add.reduceat(below_n, up_first)[at] - own
                under_distinct = np.diff(np.append(up_first, len(below)))[at] - distinct
            both, under = sums + distinct, under_total + under_distinct
            if k == 0:  # differences of logs are taken before they are cut to seven digits
                self.top = HashIndex(keys, _kept(_log10(n) - np.repeat(_log10(both), distinct)))
                keys, n = keys[:0], n[:0]  # all that the index does not hold was not seen
            self.levels.append(Level(
                keys, _kept(_log10(n)), contexts, _kept(_log10(both)), _kept(_log10(distinct) - _log10(both)), _kept(_log10(under)),
                _kept(np.where(under_distinct > 0, _log10(under_distinct) - _log10(under), 0.0)),
            ))
            tables[k] = None if k == 0 else tables[k]
        self.unseen = -math.log10(max(1, 256 - len(self.levels[-1].keys)))

    def log10(self, keys: np.ndarray) -> np.ndarray:
        """log10 of the probability of each byte after its context."""
        out, rest = self.top.get(keys)
        out = out.astype(np.float64)
        if not len(rest):
            return out
        out[rest] = 0
        total, escape = np.full(len(rest), np.nan), np.zeros(len(rest))
        for k, level in enumerate(self.levels):
            key = keys[rest] & np.uint64((1 << 8 * (ORDER - k + 1)) - 1)
            if len(level.contexts):
                c = np.minimum(np.searchsorted(level.contexts, key >> np.uint64(8)), len(level.contexts) - 1)
                here = level.contexts[c] == key >> np.uint64(8)
                fresh = here & np.isnan(total)
                total[fresh], escape[fresh] = level.total[c[fresh]], level.escape[c[fresh]]
                hit = np.zeros(len(rest), bool)
                if k:
                    e = np.minimum(np.searchsorted(level.keys, key), len(level.keys) - 1)
                    hit = level.keys[e] == key
                    out[rest[hit]] += level.log_n[e[hit]] - total[hit]
                lost = here & ~hit
                out[rest[lost]] += escape[lost]
                total = np.where(here, level.under_total[c], np.nan)[~hit]
                escape = level.under_escape[c][~hit]
                rest = rest[~hit]
            if not len(rest):
                return out
        out[rest] += self.unseen
        return out


def slice_number(key: Column, slices: int) -> Column:
    """The slice of a byte run, by its last two context bytes."""
    return F.pmod(F.shiftright(key, 8).bitwiseAND(F.lit(0xFFFF)) * F.lit(40503), F.lit(slices))


_cache: dict = {}


def _loaded(sent) -> tuple:
    """The model of a broadcast, built once per worker."""
    if sent.value[0] not in _cache:
        name, grams, pairs, vocabulary = sent.value
        _cache.clear()
        _cache[name] = Ppm(grams, pairs), vocabulary
    return _cache[sent.value[0]]


def _arrays(rows: DataFrame) -> tuple[np.ndarray, np.ndarray]:
    """key and n of a bounded table, sorted by key."""
    found = rows.select("key", "n").toArrow()
    keys, n = np.asarray(found["key"]).view(np.uint64), np.asarray(found["n"])
    n = n.astype(np.int32) if not len(n) or n.max() < 1 << 31 else n
    order = np.argsort(keys)
    return keys[order], n[order]


def byte_scores(batch: pa.RecordBatch, model: Ppm, number: int, slices: int) -> Iterator[tuple[words.Piece, np.ndarray]]:
    for piece in words.pieces(batch["text"], words.SOLID, lower=True, limit=PIECE):
        keys, starts = byte_keys(piece)
        if slices == 1:
            logs = model.log10(keys)
        else:
            own = ((keys >> np.uint64(8)) & np.uint64(0xFFFF)) * np.uint64(40503) % np.uint64(slices) == np.uint64(number)
            logs = np.zeros(len(keys))
            logs[own] = model.log10(keys[own])
        sums = np.concatenate([[0.0], np.cumsum(logs)])
        yield piece, sums[starts[1:]] - sums[starts[:-1]]


def score(docs: DataFrame, fold: int = 2, folds: int = 7, nodes: int = NODES, vocabulary_size: int = VOCABULARY) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score for every row."""
    spark = docs.sparkSession
    key = docs.schema["doc_id"].dataType.simpleString()
    tagged = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.xxhash64("text").alias("tag"), held_out(fold, folds).alias("held_out"))
    found = at_rest(counts(tagged.where("NOT held_out")), "counts")
    grams, vocabulary = found.where(F.col("kind") == GRAM), found.where(F.col("kind") == WORD)
    stats = vocabulary.agg(F.sum("n"), F.count("*")).first()
    tokens, distinct = stats[0] or 0, stats[1]
    slices = max(1, -(-grams.count() // nodes))
    levels = vocabulary.groupBy(F.floor(F.log2("n")).alias("l")).count().orderBy(F.desc("l")).collect()
    least, sum_ = 1, 0
    for row in levels:
        sum_ += row["count"]
        if sum_ > vocabulary_size:
            least = 1 << (row["l"] + 1)
            break
    frequent, rare = vocabulary.where(F.col("n") >= least), vocabulary.where(F.col("n") < least)
    pairs = _arrays(grams.groupBy(F.col("key").bitwiseAND(F.lit(0xFFFF)).alias("key")).agg(F.sum("n").alias("n")))
    unit = math.log10(tokens + distinct + 1)

    def sent(number: int, table) -> object:
        return spark.sparkContext.broadcast((uuid.uuid4().hex, _arrays(grams.where(slice_number(F.col("key"), slices) == number)), pairs, table))

    def first_pass(model_sent):
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, (known, n) = _loaded(model_sent)
            for batch in batches:
                for piece, logs in byte_scores(batch, model, 0, slices):
                    size, count = piece.hi - piece.lo, piece.counts
                    token = np.concatenate([piece.hash, np.full(size, _END_WORD)])
                    row = np.concatenate([piece.row, np.arange(size)])
                    at = np.minimum(np.searchsorted(known, token), max(0, len(known) - 1))
                    hit = known[at] == token if len(known) else np.zeros(len(token), bool)
                    c = np.where(hit, n[at], 0) if len(known) else np.zeros(len(token), np.int64)
                    base = np.bincount(row, np.log10(c + 1.0) - unit, size)
                    tail = np.flatnonzero(~hit) if least > 1 else np.zeros(0, np.int64)
                    tail = tail[np.argsort(row[tail], kind="stable")]
                    ends = np.concatenate([[0], np.cumsum(np.bincount(row[tail], minlength=size))]).astype(np.int32)
                    part = batch.slice(piece.lo, size)
                    yield pa.RecordBatch.from_arrays([
                        part["doc_id"], part["tag"], part["held_out"], pa.array(count + 1), pa.array(np.bincount(row[hit], minlength=size)),
                        pa.array(base), pa.array(logs), pa.ListArray.from_arrays(pa.array(ends), pa.array(token[tail].view(np.int64))),
                    ], ["doc_id", "tag", "held_out", "n_tokens", "n_known", "base_score", "score", "tail"])

        return tagged.mapInArrow(step, f"doc_id {key}, tag long, held_out boolean, n_tokens long, n_known long, base_score double, score double, tail array<long>")

    def more_pass(model_sent, number: int):
        def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            model, _ = _loaded(model_sent)
            for batch in batches:
                for piece, logs in byte_scores(batch, model, number, slices):
                    part = batch.slice(piece.lo, piece.hi - piece.lo)
                    yield pa.RecordBatch.from_arrays([part["doc_id"], part["tag"], pa.array(logs)], ["doc_id", "tag", "more"])

        return tagged.mapInArrow(step, f"doc_id {key}, tag long, more double").dropDuplicates(["doc_id", "tag"])

    out = first_pass(sent(0, _arrays(frequent)))
    if least > 1 or slices > 1:
        out = at_rest(out, "scores")
    other = {"doc_id": "other_id", "tag": "other_tag"}
    same = F.col("doc_id").eqNullSafe(F.col("other_id")) & F.col("tag").eqNullSafe(F.col("other_tag"))
    if least > 1:
        tails = out.select("doc_id", "tag", "tail").where(F.size("tail") > 0).dropDuplicates(["doc_id", "tag"])
        hits = tails.select("doc_id", "tag", F.explode("tail").alias("key")).groupBy("doc_id", "tag", "key").agg(F.count("*").alias("times"))
        gain = hits.join(rare, "key").groupBy("doc_id", "tag").agg(F.sum("times").alias("more_known"), F.sum(F.col("times") * F.log10(F.col("n") + 1.0)).alias("more_base"))
        out = out.join(gain.withColumnsRenamed(other), same, "left").select(
            "doc_id", "tag", "held_out", "n_tokens", (F.col("n_known") + F.coalesce("more_known", F.lit(0))).alias("n_known"),
            (F.col("base_score") + F.coalesce("more_base", F.lit(0.0))).alias("base_score"), "score",
        )
    if slices > 1:
        rest = reduce(DataFrame.unionAll, [more_pass(sent(i, (np.zeros(0, np.uint64), np.zeros(0, np.int64))), i) for i in range(1, slices)])
        total = rest.groupBy("doc_id", "tag").agg(F.sum("more").alias("more"))
        out = out.join(total.withColumnsRenamed(other), same).select("doc_id", "held_out", "n_tokens", "n_known", "base_score", (F.col("score") + F.col("more")).alias("score"))
    return out.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(tokens).cast("bigint").alias("train_tokens"), "base_score", "score")
