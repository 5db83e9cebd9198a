"""Substring deduplication by suffix automata of reference shards.

A window of ``WINDOW`` words is dropped where the same words also start in a document with a smaller id. One automaton
of all texts fits no machine, and streaming all documents past the automata of all shards grows with the square of the
corpus; so shards are made such that equal windows always meet, and only in one shard:

1. Every window has an anchor, the ``ANCHOR``-gram of it with the smallest hash (leftmost of equals). Windows in a row
   with the same anchor form one segment. Anchors are counted over all documents; those of one document alone are out.
2. The anchors that are left go into a filter of bits, broadcast with at most ``FILTER_BITS`` bits: beyond that size
   more segments travel than needed, and the results stay the same. A second filter marks anchors of more than
   ``HOT_DOCUMENTS`` documents or ``HOT_SEGMENTS`` segments, so a shard is bounded by both.
3. The segments of one anchor are a shard. Its automaton is built from the distinct segments with the smallest id of
   their documents at each state; each document's segment is streamed through it, and the matching statistics give the
   smallest id for every window.
4. A hot anchor has no bounded shard. Its windows go one by one: they are equal or not, which 128 bits of hash decide,
   and the smallest id per window is merged before the shuffle.

Spans are merged per document and cut out of the text. Defined results: null texts have no words; a row without id is
no reference and loses nothing; ids are of any type that has an order; rows that share an id do not dedupe each other, and are told apart by their text;
extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import words
from riskloom.llm.ids import of_any_type
from riskloom.session import BROADCAST_ROWS, at_rest

WINDOW = 13
ANCHOR = 6
HOT_DOCUMENTS = 64
HOT_SEGMENTS = 1_024
FILTER_BITS = 1 << 29
BITS_PER_ANCHOR = 16
SLICES = 64
PROBES = 3


class SuffixAutomaton:
    """All substrings of some word sequences, with the smallest owner of each."""

    def __init__(self):
        self.next: list[dict] = [{}]
        self.link, self.length, self.owner = [-1], [0], [None]

    def add(self, sequence: list, owner: int) -> None:
        last = 0
        for symbol in sequence:
            last = self._extend(last, symbol)
            at = last
            while at > 0 and (self.owner[at] is None or owner < self.owner[at]):
                self.owner[at] = owner
                at = self.link[at]

    def _state(self, next_: dict, length: int, link: int, owner) -> int:
        self.next.append(next_)
        self.length.append(length)
        self.link.append(link)
        self.owner.append(owner)
        return len(self.link) - 1

    def _split(self, p: int, q: int, symbol) -> int:
        clone = self._state(dict(self.next[q]), self.length[p] + 1, self.link[q], self.owner[q])
        self.link[q] = clone
        while p >= 0 and self.next[p].get(symbol) == q:
            self.next[p][symbol] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, symbol) -> int:
        q = self.next[last].get(symbol)
        if q is not None:
            return q if self.length[q] == self.length[last] + 1 else self._split(last, q, symbol)
        new, p = self._state({}, self.length[last] + 1, 0, None), last
        while p >= 0 and symbol not in self.next[p]:
            self.next[p][symbol] = new
            p = self.link[p]
        if p >= 0:
            q = self.next[p][symbol]
            self.link[new] = q if self.length[q] == self.length[p] + 1 else self._split(p, q, symbol)
        return new

    def owners(self, sequence: list, width: int) -> list:
        """The smallest owner of each run of ``width`` symbols, by matching statistics (None: no owner)."""
        out, state, matched = [], 0, 0
        for i, symbol in enumerate(sequence):
            while state and symbol not in self.next[state]:
                state = self.link[state]
                matched = self.length[state]
            state = self.next[state].get(symbol, 0)
            matched = matched + 1 if state else 0
            if i + 1 >= width:
                at = state
                while at > 0 and self.length[self.link[at]] >= width:
                    at = self.link[at]
                out.append(self.owner[at] if matched >= width else None)
        return out


def segments(piece: words.Piece, window: int, anchor: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Anchor hash, first word and number of windows of each run of windows with the same anchor place."""
    at, h = piece.grams(anchor)
    begin, _ = piece.grams(window)
    none = np.zeros(0, np.int64)
    if not len(begin):
        return none.astype(np.uint64), none, none
    width = window - anchor + 1
    first = np.searchsorted(at, begin)
    place = first + np.lib.stride_tricks.sliding_window_view(h, width)[first].argmin(axis=1)
    cut = np.flatnonzero(np.concatenate([[True], (place[1:] != place[:-1]) | (begin[1:] != begin[:-1] + 1)]))
    return h[place[cut]], begin[cut], np.diff(np.append(cut, len(begin)))


def anchors(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Hash of every distinct anchor of every document, with the number of its segments there."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch["text"]):
                h, begin, _ = segments(piece, window, anchor)
                row = piece.row[begin]
                order = np.lexsort((h, row))
                h, row = h[order], row[order]
                new = np.ones(len(h), bool)
                new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                times = np.diff(np.append(np.flatnonzero(new), len(h)))
                yield pa.RecordBatch.from_arrays([pa.array(h[new].view(np.int64)), pa.array(times)], ["hash", "segments"])

    return docs.where("doc_id IS NOT NULL").select(F.col("text").cast("string")).mapInArrow(step, "hash long, segments long")


def _bits(h: np.ndarray, size: int) -> list[np.ndarray]:
    return [words.mix(h + np.uint64(p)) % np.uint64(size) for p in range(1, PROBES + 1)]


def _slice_of(h: np.ndarray) -> np.ndarray:
    return (h >> np.uint64(58)).astype(np.int64)


def bit_filters(shared: DataFrame, bits: int) -> list[np.ndarray]:
    """Two filters (shared anchors, hot anchors) as rows of bytes per slice; slices are built where their anchors are."""
    size = max(64, bits // SLICES // 8 * 8)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        made: dict[tuple[int, int], np.ndarray] = {}
        for batch in batches:
            h = np.asarray(batch["hash"]).view(np.uint64)
            hot = np.asarray(batch["hot"].cast(pa.int8())) > 0
            part = _slice_of(h)
            for kind, pick in ((0, np.ones(len(h), bool)), (1, hot)):
                for s in np.unique(part[pick]):
                    cells = made.setdefault((kind, int(s)), np.zeros(size, bool))
                    for at in _bits(h[pick & (part == s)], size):
                        cells[at] = True
        yield pa.RecordBatch.from_pylist(
            [{"kind": k, "slice": s, "bits": np.packbits(v).tobytes()} for (k, s), v in made.items()],
            pa.schema([("kind", pa.int64()), ("slice", pa.int64()), ("bits", pa.binary())]),
        )

    rows = shared.repartition(SLICES, F.shiftrightunsigned("hash", 58)).mapInArrow(step, "kind long, slice long, bits binary")
    out = [np.zeros((SLICES, size // 8), np.uint8) for _ in range(2)]
    for row in rows.toLocalIterator():
        out[row["kind"]][row["slice"]] |= np.frombuffer(row["bits"], np.uint8)
    return out


def passes(filter_: np.ndarray, h: np.ndarray) -> np.ndarray:
    part, size, out = _slice_of(h), filter_.shape[1] * 8, np.ones(len(h), bool)
    for at in _bits(h, size):
        byte, bit = (at >> np.uint64(3)).astype(np.int64), (at & np.uint64(7)).astype(np.uint8)
        out &= (filter_[part, byte] >> (np.uint8(7) - bit)) & np.uint8(1) > 0
    return out


def _ranges(first: np.ndarray, count: np.ndarray) -> np.ndarray:
    """The numbers from each ``first``, ``count`` of them."""
    return np.repeat(first - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum()) if len(first) else first


def _told_apart(docs: DataFrame) -> DataFrame:
    return docs.where("doc_id IS NOT NULL").select("doc_id", F.xxhash64("text").alias("tag"), F.col("text").cast("string"))


def shard_rows(docs: DataFrame, filters, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Segments of shared anchors that are not hot, with their words."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        shared, hot = filters.value
        for batch in batches:
            for piece in words.pieces(batch["text"]):
                h, begin, count = segments(piece, window, anchor)
                pick = np.flatnonzero(passes(shared, h))
                pick = pick[~passes(hot, h[pick])]
                begin, end = begin[pick], begin[pick] + count[pick] + window - 1
                row = piece.row[begin]
                rows = pa.array(row + piece.lo)
                texts = [piece.text(b, e) for b, e in zip(begin.tolist(), end.tolist())]
                yield pa.RecordBatch.from_arrays([
                    pa.array(h[pick].view(np.int64)), batch["doc_id"].take(rows), batch["tag"].take(rows),
                    pa.array(begin - piece.first[row]), pa.array(texts, pa.binary()),
                ], ["key", "doc_id", "tag", "begin", "words"])

    return _told_apart(docs).mapInArrow(step, "key long, doc_id long, tag long, begin long, words binary")


def hot_windows(docs: DataFrame, filters, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """Windows of hot anchors with 128 bits of hash."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        _, hot = filters.value
        for batch in batches:
            for piece in words.pieces(batch["text"]):
                h, begin, count = segments(piece, window, anchor)
                pick = np.flatnonzero(passes(hot, h))
                start = _ranges(begin[pick], count[pick])
                at, key = piece.grams(window)
                second = np.zeros(len(start), np.uint64)
                for j in range(window):
                    second = second * np.uint64(0x2545F4914F6CDD1D) + words.mix(piece.hash[start + j] + np.uint64(7))
                row = piece.row[start]
                rows = pa.array(row + piece.lo)
                yield pa.RecordBatch.from_arrays([
                    pa.array(key[np.searchsorted(at, start)].view(np.int64)), pa.array(words.mix(second).view(np.int64)),
                    batch["doc_id"].take(rows), batch["tag"].take(rows), pa.array(start - piece.first[row]),
                ], ["key", "check", "doc_id", "tag", "begin"])

    return _told_apart(docs).mapInArrow(step, "key long, check long, doc_id long, tag long, begin long")


def shard_spans(rows: list[tuple[int, int, int, bytes]], window: int) -> Iterator[tuple[int, int, int, int]]:
    """(doc_id, tag, first word, end) of the runs of windows that a smaller id has too, within one anchor's rows."""
    least: dict[bytes, int] = {}
    for doc, _, _, text in rows:
        least[text] = min(doc, least.get(text, doc))
    known: dict[bytes, list] = {}
    if len(least) > 1:
        automaton, split = SuffixAutomaton(), {t: t.split(b" ") for t in least}
        for text, own in split.items():
            automaton.add(own, least[text])
        known = {t: automaton.owners(own, window) for t, own in split.items()}
    for doc, tag, begin, text in rows:
        owners = known.get(text) or [least[text]] * (text.count(b" ") + 2 - window)
        i = 0
        while i < len(owners):
            if owners[i] < doc:
                first = i
                while i < len(owners) and owners[i] < doc:
                    i += 1
                yield doc, tag, begin + first, begin + i - 1 + window
            i += 1


SPAN = "doc_id long, tag long, s long, e long"


def automaton_spans(cold: DataFrame, window: int = WINDOW) -> DataFrame:
    """Spans from the automata of the shards; rows of one anchor arrive one after the other."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, held = None, []
        for batch in batches:
            out = []
            for k, *row in zip(*[batch[c].to_pylist() for c in ("key", "doc_id", "tag", "begin", "words")]):
                if k != key:
                    out += shard_spans(held, window) if len(held) > 1 else ()
                    key, held = k, []
                held.append(row)
            yield _span_batch(out)
        yield _span_batch(list(shard_spans(held, window)) if len(held) > 1 else [])

    return cold.repartition("key").sortWithinPartitions("key").mapInArrow(step, SPAN)


def _span_batch(rows: list[tuple[int, int, int, int]]) -> pa.RecordBatch:
    columns = list(zip(*rows)) if rows else [[]] * 4
    return pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], ["doc_id", "tag", "s", "e"])


def repeated_spans(docs: DataFrame, window: int = WINDOW, anchor: int = ANCHOR) -> DataFrame:
    """doc_id, tag and the spans (word numbers) that a document with a smaller id has too."""
    spark = docs.sparkSession
    found = anchors(docs, window, anchor).groupBy("hash").agg(F.count("*").alias("documents"), F.sum("segments").alias("segments")).where("documents > 1")
    hot = (F.col("documents") > HOT_DOCUMENTS) | (F.col("segments") > HOT_SEGMENTS)
    shared = at_rest(found.select("hash", hot.alias("hot")), "anchors")
    bits = min(FILTER_BITS, max(1 << 16, BITS_PER_ANCHOR * shared.count()))
    filters = spark.sparkContext.broadcast(bit_filters(shared, bits))
    hot = at_rest(hot_windows(docs, filters, window, anchor), "hot-windows")
    first = hot.groupBy("key", "check").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").drop("high")
    single = hot.join(first, ["key", "check"]).where("low < doc_id").select("doc_id", "tag", F.col("begin").alias("s"), (F.col("begin") + window).alias("e"))
    return automaton_spans(shard_rows(docs, filters, window, anchor), window).union(single)


def cut_out(docs: DataFrame, spans: DataFrame, with_text: bool = False) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 (and the kept words, joined by blanks, if asked for)."""
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string" + ", kept string" * with_text

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            begins, ends = batch["begins"].to_pylist(), batch["ends"].to_pylist()
            for piece in words.pieces(batch["text"]):
                n, removed, digests, texts = piece.hi - piece.lo, [], [], []
                for r in range(n):
                    a, b = int(piece.first[r]), int(piece.first[r + 1])
                    stay = np.ones(b - a, bool)
                    for s, e in zip(begins[piece.lo + r] or (), ends[piece.lo + r] or ()):
                        stay[s:e] = False
                    at = a + np.flatnonzero(stay)
                    kept = b" ".join([piece.data[s:e].tobytes() for s, e in zip(piece.start[at].tolist(), piece.end[at].tolist())])
                    removed.append(b - a - len(at))
                    digests.append(hashlib.sha256(kept).hexdigest())
                    if with_text:
                        texts.append(kept.decode("utf-8", "replace"))
                arrays = [batch["doc_id"].slice(piece.lo, n), pa.array(piece.counts.astype(np.int64)), pa.array(removed, pa.int64()), pa.array(digests, pa.string())]
                arrays += [pa.array(texts, pa.string())] if with_text else []
                yield pa.RecordBatch.from_arrays(arrays, ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"][: len(arrays)])

    gathered = at_rest(spans.groupBy("doc_id", "tag").agg(F.collect_set(F.struct("s", "e")).alias("spans")), "spans")
    tagged = docs.select("doc_id", F.xxhash64("text").alias("tag"), F.col("text").cast("string"))
    many, same = gathered.count(), ["doc_id", "tag"]
    none = F.lit(None).cast("array<struct<s:bigint,e:bigint>>")
    if many <= BROADCAST_ROWS:  # then only the texts that change are moved
        names = F.broadcast(gathered.select(*same))
        joined = tagged.join(names, same, "left_semi").join(gathered, same, "left")
        joined = joined.union(tagged.join(names, same, "left_anti").select("*", none.alias("spans")))
    else:
        joined = tagged.join(gathered, same, "left")
    return joined.select("doc_id", "text", F.col("spans.s").alias("begins"), F.col("spans.e").alias("ends")).mapInArrow(step, schema)


@of_any_type("doc_id")
def dedup_report(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    return cut_out(docs, repeated_spans(docs, window))
