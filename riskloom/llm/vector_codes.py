"""Vector code compression: product codes by exact k-means whose rescans norm-of-sum bounds avoid.

Every component becomes ``floor(SCALE * x)``, every vector is cut into ``PARTS`` equal parts, and each part position has
a codebook of ``ENTRIES`` entries that ``ROUNDS`` rounds of assignment and mean refine. For each part of each vector two
bounds are kept: the distance to its own entry, and the distance to the nearest other entry, both exact squares of the
round in which they were taken, with that round as their stamp. The codebooks of all rounds are kept too, so a bound of
round s holds in round t up to the net displacement ``|C_t - C_s|`` of the entries; steps of the rounds between that cancel
out cost nothing, as they would if the drifts were added up. Where the bounds leave the own entry strictly nearest nothing is computed;
else its distance is taken anew, and only where that does not decide either, all entries are scanned. All distances are
whole numbers, so bounds that are close by less than rounding lead to a scan and results are exact.

A round is two passes over tables in the shared folder: one writes codes, bounds and stamps, the next sums the parts per
entry, first inside each task; the driver sees the sums of a codebook. A table of a round is deleted when the next is there.

Defined results: vectors that are null, empty or hold null, NaN or infinite entries are dropped, with their rows. The first entries
are those of the smallest ids; a null id comes last, rows that share an id go by their components; fewer vectors than
entries make a smaller codebook. Repeated rows count one by one. A label may have any type; null labels are one group.
Vectors of different lengths, lengths that are no multiple of ``PARTS``, and
components of ``LARGEST`` or more after scaling are an error. Extra columns are ignored; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from riskloom.llm import vectors
from riskloom.llm.scratch import Scratch
from riskloom.session import broadcast_if_small

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
LARGEST = 1 << 27
STATE = "id {id}, label {label}, x array<bigint>, codes binary, own binary, own_round binary, other binary, other_round binary, scanned bigint"


def cut(x: np.ndarray, parts: int) -> np.ndarray:
    """parts x vectors x components."""
    if x.size and (x.max() >= LARGEST or x.min() <= -LARGEST):
        raise ValueError(f"components of {LARGEST} or more after scaling: squared distances would not fit")
    return np.ascontiguousarray(x.reshape(len(x), parts, x.shape[1] // parts).transpose(1, 0, 2))


def distances(part: np.ndarray, book: np.ndarray) -> np.ndarray:
    """vectors x entries, squared."""
    return (part * part).sum(axis=1)[:, None] - 2 * part @ book.T + (book * book).sum(axis=1)[None, :]


def to_own(part: np.ndarray, book: np.ndarray, code: np.ndarray) -> np.ndarray:
    apart = part - book[code]
    return (apart * apart).sum(axis=1)


def moved(history: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """By round and entry: the net displacement until the last round of an entry, and the largest one of all others."""
    net = np.sqrt(((history - history[-1]) ** 2).sum(axis=2).astype(np.float64))
    others = np.zeros_like(net)
    for j in range(net.shape[1]):
        others[:, j] = np.delete(net, j, axis=1).max(axis=1, initial=0.0)
    return net, others


def scan(part: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Code, squared distance to it, and to the nearest other entry (the largest number if there is none)."""
    d = distances(part, book)
    code = d.argmin(axis=1)
    at = np.arange(len(d))
    own = d[at, code]
    d[at, code] = np.iinfo(np.int64).max
    return code, own, d.min(axis=1)


class Bounds:
    """Codes and stamped bounds of one part position for some vectors."""

    def __init__(self, code, own, own_round, other, other_round):
        self.code, self.own, self.own_round, self.other, self.other_round = code, own, own_round, other, other_round

    @classmethod
    def first(cls, part: np.ndarray, book: np.ndarray) -> Bounds:
        code, own, other = scan(part, book)
        zero = np.zeros(len(part), np.uint8)
        return cls(code, own, zero, other, zero.copy())

    def undecided(self, net: np.ndarray, others: np.ndarray) -> np.ndarray:
        """Where the own entry is not surely nearer than all others now."""
        upper = np.sqrt(self.own.astype(np.float64)) + net[self.own_round, self.code]
        lower = np.sqrt(self.other.astype(np.float64)) - others[self.other_round, self.code]
        return np.flatnonzero(~(lower > upper * (1 + 1e-12) + 1e-6))

    def update(self, part: np.ndarray, history: np.ndarray) -> int:
        """Bring the codes to the last round; the number of parts that had to be scanned."""
        now, book = len(history) - 1, history[-1]
        net, others = moved(history)
        open_ = self.undecided(net, others)
        self.own[open_], self.own_round[open_] = to_own(part[open_], book, self.code[open_]), now
        again = open_[np.isin(open_, self.undecided(net, others), assume_unique=True)]
        self.code[again], self.own[again], self.other[again] = scan(part[again], book)
        self.other_round[again] = now
        return len(again)


def _bytes(columns: list[np.ndarray], kind) -> pa.Array:
    return pa.array([row.tobytes() for row in np.stack(columns, axis=1).astype(kind)], pa.binary())


def _numbers(column: pa.Array, kind, parts: int) -> list[np.ndarray]:
    """One array per part position."""
    rows = np.frombuffer(b"".join(column.to_pylist()), kind).reshape(len(column), parts)
    return [rows[:, p].copy() for p in range(parts)]


def assign(state: DataFrame, history: np.ndarray, schema: str, parts: int) -> DataFrame:
    """The rows with codes and bounds brought to the last codebook of ``history`` (parts x rounds x entries x components)."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            cuts = cut(vectors.matrix(batch["x"]), parts)
            if history.shape[1] == 1:
                bounds = [Bounds.first(cuts[p], history[p, 0]) for p in range(parts)]
                scanned = parts * batch.num_rows
            else:
                old = [_numbers(batch["codes"], np.uint8, parts), _numbers(batch["own"], np.int64, parts), _numbers(batch["own_round"], np.uint8, parts),
                       _numbers(batch["other"], np.int64, parts), _numbers(batch["other_round"], np.uint8, parts)]
                bounds = [Bounds(code.astype(np.int64), own, own_round, other, other_round) for code, own, own_round, other, other_round in zip(*old)]
                scanned = sum(b.update(cuts[p], history[p]) for p, b in enumerate(bounds))
            of_row = np.zeros(batch.num_rows, np.int64)
            of_row[0] = scanned
            yield pa.RecordBatch.from_arrays([
                batch["id"], batch["label"], batch["x"], _bytes([b.code for b in bounds], np.uint8), _bytes([b.own for b in bounds], np.int64),
                _bytes([b.own_round for b in bounds], np.uint8), _bytes([b.other for b in bounds], np.int64),
                _bytes([b.other_round for b in bounds], np.uint8), pa.array(of_row),
            ], ["id", "label", "x", "codes", "own", "own_round", "other", "other_round", "scanned"])

    return state.mapInArrow(step, schema)


def sums(state: DataFrame, shape: tuple[int, int, int]) -> DataFrame:
    """slot, n, total: per part, entry and component how many parts the entry has and their sum."""
    parts, entries, size = shape

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, total = np.zeros((parts, entries), np.int64), np.zeros((parts, entries, size), np.int64)
        for batch in batches:
            if batch.num_rows:
                cuts = cut(vectors.matrix(batch["x"]), parts)
                for p, code in enumerate(_numbers(batch["codes"], np.uint8, parts)):
                    n[p] += np.bincount(code, minlength=entries)
                    np.add.at(total[p], code, cuts[p])
        slots = np.flatnonzero(np.repeat(n.ravel(), size))
        yield pa.RecordBatch.from_arrays([pa.array(slots), pa.array(n.ravel()[slots // size]), pa.array(total.ravel()[slots])], ["slot", "n", "total"])

    partial = state.select("x", "codes").mapInArrow(step, "slot bigint, n bigint, total bigint")
    return partial.groupBy("slot").agg(F.sum("n").alias("n"), F.sum("total").alias("total"))


def next_book(book: np.ndarray, state: DataFrame) -> np.ndarray:
    """Every used entry replaced by the floor of the mean of its parts."""
    out = book.copy()
    flat = out.reshape(-1)
    for slot, n, total in sums(state, book.shape).collect():
        flat[slot] = total // n
    return out


def digest(book: np.ndarray) -> str:
    return hashlib.sha256(",".join(map(str, book.ravel().tolist())).encode()).hexdigest()


def encode(
    table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label",
    parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS, scale: int = SCALE,
) -> tuple[DataFrame, np.ndarray, list[int]]:
    """id, label, codes, errors by row, with the last codebooks and the number of scanned parts of each assignment."""
    scratch = Scratch(table.sparkSession)
    kept = table.select(F.col(key).alias("id"), F.col(label).alias("label"), F.col(vector).alias("v")).where(vectors.usable("v"))
    state = scratch.rest(kept.select("id", "label", vectors.grid("v", scale).alias("x")), "vector-state")
    size = vectors.width(state, "x")
    if size % parts:
        raise ValueError(f"vectors of {size} entries cannot be cut into {parts} equal parts")
    schema = STATE.format(**{c: state.schema[c].dataType.simpleString() for c in ("id", "label")})
    first = [r["x"] for r in state.orderBy(F.col("id").asc_nulls_last(), "x").limit(entries).collect()]
    history = cut(np.array(first, np.int64).reshape(len(first), size), parts)[:, None]
    scans = []
    for r in range(rounds + 1 if first else 0):
        state = scratch.rest(assign(state, history, schema, parts), "vector-state")
        scans.append(state.agg(F.sum("scanned")).first()[0])
        if r < rounds:
            history = np.concatenate([history, next_book(history[:, -1], state)[:, None]], axis=1)
    book = history[:, -1]

    def errors(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                cuts = cut(vectors.matrix(batch["x"]), parts)
                of_part = [to_own(cuts[p], book[p], code) for p, code in enumerate(_numbers(batch["codes"], np.uint8, parts))]
                yield pa.RecordBatch.from_arrays([batch["id"], batch["label"], batch["codes"], pa.array(sum(of_part))], ["id", "label", "codes", "error"])

    columns = f"{', '.join(schema.split(', ')[:2])}, codes binary, error bigint"
    if not first:
        return table.sparkSession.createDataFrame([], columns), book, scans
    coded = scratch.rest(state.select("id", "label", "x", "codes").mapInArrow(errors, columns), "vector-codes")
    scratch.drop_all_but("vector-codes")
    return coded, book, scans


def report(table: DataFrame, key: str = "vec_id", vector: str = "embedding", label: str = "label", **how) -> DataFrame:
    """Id, code, error, label_error and codebooks_sha256 of every vector that is not dropped."""
    coded, book, _ = encode(table, key, vector, label, **how)
    by_label = Scratch(table.sparkSession).rest(coded.groupBy(F.col("label").alias("of_label")).agg(F.sum("error").alias("label_error")), "label-errors")
    by_label = broadcast_if_small(by_label, by_label.count())
    return coded.join(by_label, F.col("label").eqNullSafe(F.col("of_label"))).select(
        F.col("id").alias(key), F.lower(F.hex("codes")).alias("code"), "error", "label_error", F.lit(digest(book)).alias("codebooks_sha256"),
    )
