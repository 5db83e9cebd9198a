"""Benchmark decontamination by FM-indexes of the training text.

Every piece of the training text (about 1 MB) is a shard with an FM-index of its own over word numbers: suffix array,
Burrows-Wheeler transform in a wavelet matrix, every eighth suffix position kept. All test windows are searched
backwards at once; their occurrences are located by stepping to the next kept position, compared word for word,
and merged into removal spans. Words that no test window has cannot lie in an occurrence, so runs of other words are
left out of the index (they only part the runs), which keeps it small without losing a match.

Test windows are 13 consecutive words of an item; an item of fewer words, but not none, is one window. Items are sent
to the tasks in blocks of at most ``BLOCK_WORDS`` words; beyond one block the documents pass through one such step
per block, inside the same stage.

Defined results: null texts have no words; empty documents are clean; items without words match nothing; an item
without id counts as a match but is not named; repeated rows are marked each; extra columns are ignored or,
in ``clean``, passed on; empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import words
from riskloom.session import at_rest

WINDOW = 13
KEPT_EVERY = 8
BLOCK_WORDS = 2_000_000
FOUND = "n_words long, spans array<struct<s:long,e:long>>, items array<string>"


class WaveletMatrix:
    """Ranks of symbols in a sequence, bit by bit from the highest."""

    def __init__(self, symbols: np.ndarray, bits: int):
        self.bits, self.ones, self.zeros = bits, [], []
        rest = symbols
        for level in range(bits - 1, -1, -1):
            bit = (rest >> level) & 1
            self.ones.append(np.concatenate([[0], np.cumsum(bit)]))
            self.zeros.append(len(rest) - int(self.ones[-1][-1]))
            rest = np.concatenate([rest[bit == 0], rest[bit == 1]])

    def rank(self, symbol: np.ndarray, place: np.ndarray) -> np.ndarray:
        """How often each symbol stands before each place."""
        first = np.zeros_like(place)
        for level, ones, zeros in zip(range(self.bits - 1, -1, -1), self.ones, self.zeros):
            high = (symbol >> level) & 1 == 1
            first, place = (np.where(high, zeros + ones[x], x - ones[x]) for x in (first, place))
        return place - first


def suffix_array(text: np.ndarray) -> np.ndarray:
    """Order of all suffixes by prefix doubling; the last symbol is the only 0."""
    n = len(text)
    rank, width = text.astype(np.int64), 1
    while True:
        after = np.zeros(n, np.int64)
        after[: n - width] = rank[width:] + 1 if width < n else 0
        key = rank * (max(int(rank.max()), n) + 2) + after
        order = np.argsort(key, kind="stable")
        ordered = key[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        if rank[order[-1]] == n - 1:
            return order
        width *= 2


class FmIndex:
    """Symbols from 1; 0 is added as the end."""

    def __init__(self, symbols: np.ndarray):
        text = np.concatenate([symbols, [0]]).astype(np.int64)
        order = suffix_array(text)
        self.last = text[order - 1]
        self.size = int(text.max()) + 1
        self.before = np.concatenate([[0], np.cumsum(np.bincount(text, minlength=self.size))])
        self.tree = WaveletMatrix(self.last, max(1, self.size.bit_length()))
        self.is_kept = (order % KEPT_EVERY == 0) | (order == 0)
        self.kept = np.where(self.is_kept, order, -1)

    def search(self, patterns: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Rows (lowest, end) of the sorted suffixes that start with each pattern; patterns are padded on the left."""
        low, high = np.zeros(len(patterns), np.int64), np.full(len(patterns), len(self.last), np.int64)
        width = patterns.shape[1]
        for j in range(width - 1, -1, -1):
            live = np.flatnonzero((lengths >= width - j) & (low < high))
            if not len(live):
                break
            c = patterns[live, j]
            known = (c > 0) & (c < self.size)
            c = np.where(known, c, 0)
            base = self.before[c]
            low[live] = base + self.tree.rank(c, low[live])
            high[live] = np.where(known, base + self.tree.rank(c, high[live]), low[live])
        return low, high

    def locate(self, rows: np.ndarray) -> np.ndarray:
        """Text places of rows, by steps back to a kept place."""
        rows, steps, places = rows.copy(), np.zeros(len(rows), np.int64), np.full(len(rows), -1, np.int64)
        open_ = np.arange(len(rows))
        while len(open_):
            done = self.is_kept[rows[open_]]
            places[open_[done]] = self.kept[rows[open_[done]]] + steps[open_[done]]
            open_ = open_[~done]
            c = self.last[rows[open_]]
            rows[open_] = self.before[c] + self.tree.rank(c, rows[open_])
            steps[open_] += 1
        return places


@dataclass
class Block:
    """Test windows of some items. ``patterns`` hold word numbers from 2, padded on the left with 0; 1 parts runs."""

    vocabulary: np.ndarray
    patterns: np.ndarray
    lengths: np.ndarray
    texts: list[bytes]
    owners: list[list[str]]

    @property
    def shortest(self) -> int:
        return int(self.lengths.min())


def make_block(rows: list[tuple[str | None, bytes]], window: int) -> Block | None:
    """Windows of the items' normalised words."""
    owners: dict[bytes, set[str]] = {}
    for item, text in rows:
        own = text.split(b" ") if text else []
        for i in range(max(1, len(own) - window + 1) if own else 0):
            owners.setdefault(b" ".join(own[i : i + window]), set()).update([item] if item is not None else [])
    if not owners:
        return None
    texts = sorted(owners)
    every = sorted({w for t in texts for w in t.split(b" ")})
    hashes = words.word_hashes(every)
    order = np.argsort(hashes)
    number = {every[i]: k + 2 for k, i in enumerate(order)}
    lengths = np.array([t.count(b" ") + 1 for t in texts])
    patterns = np.zeros((len(texts), window), np.int64)
    for i, t in enumerate(texts):
        own = [number[w] for w in t.split(b" ")]
        patterns[i, window - len(own) :] = own
    return Block(hashes[order], patterns, lengths, texts, [sorted(owners[t]) for t in texts])


def occurrences(piece: words.Piece, block: Block) -> list[tuple[int, int]]:
    """(window, first word) of all places where a window of the block stands in a piece."""
    if not len(piece.hash):
        return []
    slot = np.minimum(np.searchsorted(block.vocabulary, piece.hash), len(block.vocabulary) - 1)
    number = np.where(block.vocabulary[slot] == piece.hash, slot + 2, 0)
    known = number > 0
    cut = np.concatenate([[True], (known[1:] != known[:-1]) | (piece.row[1:] != piece.row[:-1])])
    begins = np.flatnonzero(cut)
    ends = np.append(begins[1:], len(known))
    use = known[begins] & (ends - begins >= block.shortest)
    begins, ends = begins[use], ends[use]
    if not len(begins):
        return []
    sizes = ends - begins + 1
    place = np.repeat(begins - np.concatenate([[0], np.cumsum(sizes)[:-1]]), sizes) + np.arange(sizes.sum())
    symbols = np.append(number, 1)[place]
    symbols[np.cumsum(sizes) - 1] = 1
    present = np.unique(symbols)
    local = np.zeros(len(block.vocabulary) + 2, np.int64)
    local[present] = np.arange(1, len(present) + 1)
    possible = np.flatnonzero(((local[block.patterns] > 0) | (block.patterns == 0)).all(axis=1))
    if not len(possible):
        return []
    index = FmIndex(local[symbols])
    low, high = index.search(local[block.patterns[possible]], block.lengths[possible])
    hit = np.flatnonzero(low < high)
    times = high[hit] - low[hit]
    rows = np.repeat(low[hit] - np.concatenate([[0], np.cumsum(times)[:-1]]), times) + np.arange(times.sum()) if len(hit) else hit
    found = zip(np.repeat(possible[hit], times).tolist(), place[index.locate(rows)].tolist())
    return [(w, at) for w, at in found if piece.text(at, at + int(block.lengths[w])) == block.texts[w]]


def merge(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[list[int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            out[-1][1] = max(out[-1][1], e)
        else:
            out.append([s, e])
    return [(s, e) for s, e in out]


def search_step(block, last: bool):
    """One pass of ``mapInArrow`` that adds the block's spans and items to those found before.

    The text is read from ``doc`` where that has it, and goes back to Spark beside ``doc`` only for a next pass.
    """

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        own = block.value
        for batch in batches:
            names = batch.schema.names
            n = batch.num_rows
            column = batch["text"] if "text" in names else batch["doc"].field("text")
            spans = [[(x["s"], x["e"]) for x in v] for v in batch["spans"].to_pylist()] if "spans" in names else [[] for _ in range(n)]
            items = batch["items"].to_pylist() if "items" in names else [[] for _ in range(n)]
            totals = np.zeros(n, np.int64)
            for piece in words.pieces(column, words.ALNUM, lower=True):
                totals[piece.lo : piece.hi] = piece.counts
                for window, at in occurrences(piece, own) if own else []:
                    row = int(piece.row[at])
                    first = at - int(piece.first[row])
                    spans[piece.lo + row].append((first, first + int(own.lengths[window])))
                    items[piece.lo + row].extend(own.owners[window])
            kind = pa.list_(pa.struct([("s", pa.int64()), ("e", pa.int64())]))
            results = [
                pa.array(totals),
                pa.array([[{"s": s, "e": e} for s, e in merge(v)] for v in spans], kind),
                pa.array([sorted(set(v)) for v in items], pa.list_(pa.string())),
            ]
            carried = [c for c in ("doc", "text") if c in names and not (last and c == "text")]
            yield pa.RecordBatch.from_arrays([*[batch[c] for c in carried], *results], [*carried, "n_words", "spans", "items"])

    return step


def item_words(items: DataFrame) -> DataFrame:
    """item_id as text, its lower-case words joined by blanks, and their number."""

    def step(batches):
        for batch in batches:
            texts, sizes = [], []
            for piece in words.pieces(batch["text"], words.ALNUM, lower=True):
                texts += [piece.text(a, b).decode("utf-8", "replace") for a, b in zip(piece.first[:-1], piece.first[1:])]
                sizes += piece.counts.tolist()
            yield pa.RecordBatch.from_arrays([batch["item_id"], pa.array(texts, pa.string()), pa.array(sizes, pa.int64())], ["item_id", "words", "size"])

    return items.select(F.col("item_id").cast("string"), F.col("text").cast("string")).mapInArrow(step, "item_id string, words string, size long")


def find(docs: DataFrame, items: DataFrame, carry: list[str], window: int = WINDOW, block_words: int = BLOCK_WORDS) -> DataFrame:
    """``doc`` (a struct of the carried columns), n_words, spans (word numbers, end exclusive, merged) and items per row."""
    spark = docs.sparkSession
    tests = at_rest(item_words(items).where("size > 0"), "test-items")
    total = tests.agg(F.sum("size")).first()[0] or 0
    blocks = max(1, -(-total // block_words))
    share = F.pmod(F.xxhash64("item_id", "words"), F.lit(blocks))
    apart = [] if "text" in carry and dict(docs.dtypes)["text"] == "string" else [F.col("text").cast("string").alias("text")]
    out = docs.select(F.struct(*[F.col(c) for c in carry]).alias("doc"), *apart)
    kind = out.schema["doc"].dataType.simpleString()
    for b in range(blocks):
        rows = [(r["item_id"], r["words"].encode()) for r in tests.where(share == b).collect()]
        sent = spark.sparkContext.broadcast(make_block(rows, window))
        last = b == blocks - 1
        out = out.mapInArrow(search_step(sent, last), f"doc {kind}, " + "text string, " * (bool(apart) and not last) + FOUND)
    return out


def report(docs: DataFrame, items: DataFrame) -> DataFrame:
    """doc_id, n_words, n_hit, n_items, items_sha256 and contaminated for every document."""
    found = find(docs, items, ["doc_id"])
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["e"] - s["s"]).alias("n_hit")
    return found.select(
        F.col("doc.doc_id").alias("doc_id"), "n_words", hit, F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join(F.array_sort("items"), ","), 256).alias("items_sha256"),
    ).withColumn("contaminated", (F.col("n_hit") > 0) & (20 * F.col("n_hit") >= F.col("n_words")))


def clean(docs: DataFrame, items: DataFrame) -> DataFrame:
    """The rows that are not contaminated, with their columns."""
    found = find(docs, items, docs.columns)
    hit = F.aggregate("spans", F.lit(0).cast("bigint"), lambda a, s: a + s["e"] - s["s"])
    return found.where(~((hit > 0) & (20 * hit >= F.col("n_words")))).select("doc.*")
