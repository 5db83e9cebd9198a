"""Toxicity by a weighted finite-state grammar over clauses.

Five transducers read the classes of a clause's words and are composed into one machine:

* threat: accepts an intent, a word of violence and a target, the last two in either order; such a word alone is nothing,
* insult: accepts each insult and each learned word,
* negation: a mark for a few words after a negation,
* reported speech: a mark from a verb of saying to the end of the clause,
* target: a mark from a word for a person on, for insults and learned words.

What is accepted adds its weight times the factors of the marks it stands under. Clauses end at ``. ! ? ; :`` and line ends.
A text's score comes from its matched clauses: a logistic function of the logarithms of the heaviest and of the weight
per clause of the text, neither of which grows with its length. Words that carry weight are a short list and what is
learned: whole words and word beginnings (``PREFIXES`` bytes) in at least ``LEAST_TEXTS`` toxic training texts, whose log
odds between toxic and other ones pass ``LEAST_ODDS``. A learned word weighs the lower confidence bound of its log odds
(``DEVIATIONS`` standard errors below), so rare words weigh less; words with a bound of zero or less are left out. The fit uses at most ``SAMPLE_ROWS`` labelled rows,
those with the smallest hash of their id; texts never come to the driver.

Defined results: null and empty texts match no clause and get the score of no match; without labels of both kinds
the list alone counts, with fixed coefficients; documents without label are scored like any other; of several labels for
an id the highest counts; a null id belongs to the training side but is never labelled. Extra columns are ignored or
passed on. Empty tables give empty results.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from riskloom.llm import words
from riskloom.session import at_rest

SAMPLE_ROWS = 20_000
LEXICON_ROWS = 20_000
PREFIXES = (4, 5, 6)
LEAST_ODDS = 3.0
LEAST_TEXTS = 4
DEVIATIONS = 1.645
THRESHOLD = 0.7

SYMBOLS = 10
OTHER, HARM, TARGET, NEGATION, REPORT, INTENT, VIOLENCE, LEARNED, INSULT, THREAT = range(SYMBOLS)
LISTS = {
    HARM: "idiot idiots moron morons stupid loser losers scum trash worthless pathetic disgusting imbecile",
    VIOLENCE: "kill hurt destroy strangle",
    INTENT: "will ll gonna going want must should werde werden wird vais va veux voy vamos quiero",
    TARGET: "you your yourself he she him her they them du dich ihr euch sie tu te vous toi usted ustedes ellos",
    NEGATION: "not no never isn aren don nicht kein keine pas jamais nunca tampoco",
    REPORT: "said says called calls wrote reported quoted claimed sagte schrieb dit écrit dijo escribió",
}
LIST_WEIGHT = 2.0
NEGATED, REPORTED, TARGETED = 0.5, 0.5, 1.5
THREAT_WEIGHT = LIST_WEIGHT * TARGETED
NEGATION_REACH = 3
#: What the first two machines accept.
ACCEPTED = (INSULT, LEARNED, THREAT)

#: A transducer: (state, symbol) -> (state, symbol passed on, factor of an accepted word). State 0 is the first.
Transducer = dict[tuple[int, int], tuple[int, int, float]]


def _threat() -> Transducer:
    """States: nothing, intent, intent and violence, intent and target. A violence word is passed on as any other."""
    table = {(state, symbol): (state, OTHER if symbol == VIOLENCE else symbol, 1.0) for state in range(4) for symbol in range(SYMBOLS)}
    for state in range(4):
        table[state, INTENT] = max(state, 1), INTENT, 1.0
    table[1, VIOLENCE] = 2, OTHER, 1.0
    table[1, TARGET] = 3, TARGET, 1.0
    table[2, TARGET] = table[3, VIOLENCE] = 0, THREAT, 1.0
    return table


def _insult() -> Transducer:
    return {(0, symbol): (0, INSULT if symbol == HARM else symbol, 1.0) for symbol in range(SYMBOLS)}


def _negation() -> Transducer:
    table = {}
    for state in range(NEGATION_REACH + 1):
        for symbol in range(SYMBOLS):
            after = NEGATION_REACH if symbol == NEGATION else max(0, state - 1)
            table[state, symbol] = after, symbol, NEGATED if symbol in ACCEPTED and state else 1.0
    return table


def _switch(on: int, factor: float, of: tuple[int, ...] = ACCEPTED) -> Transducer:
    """After the symbol ``on`` every word of ``of`` has the factor, to the end of the clause."""
    return {(state, symbol): (1 if symbol == on else state, symbol, factor if symbol in of and state else 1.0) for state in (0, 1) for symbol in range(SYMBOLS)}


def compose(first: Transducer, second: Transducer) -> Transducer:
    """The machine that passes each symbol through both; states are numbered as found, from 0."""
    number, table, waiting = {(0, 0): 0}, {}, [(0, 0)]
    while waiting:
        pair = waiting.pop()
        for symbol in range(SYMBOLS):
            a, out, x = first[pair[0], symbol]
            b, out, y = second[pair[1], out]
            if (a, b) not in number:
                number[a, b] = len(number)
                waiting.append((a, b))
            table[number[pair], symbol] = number[a, b], out, x * y
    return table


GRAMMAR = compose(compose(compose(compose(_threat(), _insult()), _negation()), _switch(REPORT, REPORTED)), _switch(TARGET, TARGETED, (INSULT, LEARNED)))


@dataclass
class Lexicon:
    """Hashes of words with their class and weight, and of word beginnings with their weight, by size."""

    words: np.ndarray
    classes: np.ndarray
    weights: np.ndarray
    prefixes: dict[int, tuple[np.ndarray, np.ndarray]]


def lexicon(learned: list[tuple[int, int, float]]) -> Lexicon:
    """``learned``: (size of the beginning or 0, hash, weight)."""
    table: dict[int, tuple[int, float]] = {}
    for kind, text in LISTS.items():
        for h in words.word_hashes([w.encode() for w in text.split()]):
            table[int(h)] = kind, LIST_WEIGHT if kind == HARM else 0.0
    for size, h, weight in learned:
        if size == 0:
            table[h] = LEARNED, weight
    order = sorted(table)
    prefixes = {}
    for size in PREFIXES:
        own = sorted((h, w) for s, h, w in learned if s == size)
        prefixes[size] = np.array([h for h, _ in own], np.uint64), np.array([w for _, w in own])
    return Lexicon(np.array(order, np.uint64), np.array([table[h][0] for h in order]), np.array([table[h][1] for h in order]), prefixes)


def _find(table: np.ndarray, h: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    if not len(table) or not len(h):
        return np.zeros(len(h), bool), np.zeros(len(h), np.int64)
    at = np.minimum(np.searchsorted(table, h), len(table) - 1)
    return table[at] == h, at


_STOP = np.zeros(256, bool)
_STOP[[*b".!?;:\n\r"]] = True


def _ends(piece: words.Piece) -> np.ndarray:
    """Which words are the last of their clause."""
    stops = np.concatenate([[0], np.cumsum(_STOP[piece.data])])
    ends = np.ones(len(piece.hash), bool)
    ends[:-1] = (stops[piece.start[1:]] > stops[piece.end[:-1]]) | (piece.row[1:] != piece.row[:-1])
    return ends


def clause_scores(piece: words.Piece, lex: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: sum of the weights of matched clauses, the heaviest, and their number."""
    n = piece.hi - piece.lo
    total, most, matched = np.zeros(n), np.zeros(n), np.zeros(n, np.int64)
    if not len(piece.hash):
        return total, most, matched
    found, at = _find(lex.words, piece.hash)
    symbol = np.where(found, lex.classes[at], OTHER)
    weight = np.where(found, lex.weights[at], 0.0)
    for size, (table, weights) in lex.prefixes.items():
        place, h = piece.prefixes(size)
        hit, at = _find(table, h)
        place, heavier = place[hit], weights[at[hit]] if len(weights) else np.zeros(0)
        better = heavier > weight[place]
        symbol[place[better]], weight[place[better]] = LEARNED, heavier[better]
    harm = np.flatnonzero(np.isin(symbol, (HARM, VIOLENCE, LEARNED)))
    if not len(harm):
        return total, most, matched
    first = np.concatenate([[0], np.flatnonzero(_ends(piece)) + 1])
    for c in np.unique(np.searchsorted(first, harm, "right") - 1).tolist():
        a, b = int(first[c]), int(first[c + 1])
        state, sum_ = 0, 0.0
        for s, w in zip(symbol[a:b].tolist(), weight[a:b].tolist()):
            state, out, factor = GRAMMAR[state, s]
            if out in ACCEPTED:
                sum_ += (THREAT_WEIGHT if out == THREAT else w) * factor
        if not sum_:
            continue
        row = piece.row[a]
        total[row] += sum_
        most[row] = max(most[row], sum_)
        matched[row] += 1
    return total, most, matched


def held_out(fold: int = 1, folds: int = 3) -> Column:
    return F.pmod(F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")), F.lit(folds)) == fold


def _sample(docs: DataFrame, labels: DataFrame, fold: int, folds: int, rows: int) -> DataFrame:
    """Texts and labels of the training rows with the smallest hashes, at rest."""
    usable = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(fold, folds))
    one = usable.groupBy("doc_id").agg(F.max("toxic").alias("toxic")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    chosen = one.select(F.col("doc_id").alias("label_id"), "toxic")
    texts = docs.select(F.col("doc_id"), F.col("text").cast("string").alias("text"))
    return at_rest(texts.join(F.broadcast(chosen), F.col("doc_id") == F.col("label_id")).select("text", F.col("toxic").cast("long").alias("toxic")), "labelled")


def learn_terms(sample: DataFrame, n_toxic: int, n_other: int) -> list[tuple[int, int, float]]:
    """(size, hash, lower bound of the log odds) of the words and word beginnings that mark toxic texts."""

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            toxic = np.asarray(batch["toxic"]) > 0
            for piece in words.pieces(batch["text"], words.ALNUM, lower=True):
                every = np.arange(len(piece.hash))
                for size, (at, h) in {0: (every, piece.hash), **{s: piece.prefixes(s) for s in PREFIXES}}.items():
                    row = piece.row[at]
                    order = np.lexsort((h, row))
                    h, row = h[order], row[order]
                    new = np.ones(len(h), bool)
                    new[1:] = (h[1:] != h[:-1]) | (row[1:] != row[:-1])
                    h, mark = h[new], toxic[piece.lo + row[new]]
                    keys, back = np.unique(h, return_inverse=True)
                    bad = np.bincount(back, mark, len(keys)).astype(np.int64)
                    both = np.bincount(back, minlength=len(keys))
                    yield pa.RecordBatch.from_arrays([pa.array(np.full(len(keys), size)), pa.array(keys.view(np.int64)), pa.array(bad), pa.array(both)], ["size", "hash", "bad", "all"])

    found = sample.mapInArrow(step, "size long, hash long, bad long, all long").groupBy("size", "hash").agg(F.sum("bad").alias("bad"), F.sum("all").alias("all"))
    cells = [F.col("bad") + 0.5, n_toxic - F.col("bad") + 0.5, F.col("all") - F.col("bad") + 0.5, n_other - F.col("all") + F.col("bad") + 0.5]
    odds = F.log(cells[0] / cells[1]) - F.log(cells[2] / cells[3])
    bound = odds - DEVIATIONS * F.sqrt(sum(1 / c for c in cells))
    marking = found.where(F.col("bad") >= LEAST_TEXTS).withColumn("bound", bound).where((odds >= LEAST_ODDS) & (F.col("bound") > 0))
    best = marking.orderBy(F.desc("bound"), F.desc("bad"), "size", "hash").limit(LEXICON_ROWS)
    return [(r["size"], r["hash"] % (1 << 64), r["bound"]) for r in best.collect()]


def evidence(piece: words.Piece, lex: Lexicon) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per text: weight of the heaviest clause, weight per clause, and the number of matched clauses."""
    total, most, matched = clause_scores(piece, lex)
    clauses = np.bincount(piece.row[_ends(piece)], minlength=len(total)) if len(piece.hash) else np.zeros(len(total))
    return most, total / np.maximum(clauses, 1), matched


def _features(most: np.ndarray, rate: np.ndarray) -> np.ndarray:
    return np.stack([np.ones(len(most)), np.log1p(most), np.log1p(rate)], axis=1)


def _logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> np.ndarray:
    """Coefficients by Newton steps under a small ridge."""
    beta = np.zeros(x.shape[1])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        hessian = (x * (p * (1 - p))[:, None]).T @ x + ridge * np.eye(len(beta))
        move = np.linalg.solve(hessian, x.T @ (y - p) - ridge * beta)
        beta += np.clip(move, -2, 2)
    return beta


DEFAULT = np.array([-2.5, 2.5, 0.0])


def fit(docs: DataFrame, labels: DataFrame, fold: int = 1, folds: int = 3, rows: int = SAMPLE_ROWS) -> tuple[Lexicon, np.ndarray]:
    sample = _sample(docs, labels, fold, folds, rows)
    by_class: dict[bool, int] = {}
    for r in sample.groupBy("toxic").count().collect():
        by_class[r["toxic"] > 0] = by_class.get(r["toxic"] > 0, 0) + r["count"]
    if len(by_class) < 2:
        return lexicon([]), DEFAULT
    lex = lexicon(learn_terms(sample, by_class[True], by_class[False]))
    sent = docs.sparkSession.sparkContext.broadcast(lex)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for piece in words.pieces(batch["text"], words.ALNUM, lower=True):
                most, rate, _ = evidence(piece, sent.value)
                yield pa.RecordBatch.from_arrays([pa.array(most), pa.array(rate), batch["toxic"].slice(piece.lo, piece.hi - piece.lo)], ["most", "rate", "toxic"])

    scored = sample.mapInArrow(step, "most double, rate double, toxic long").toArrow()
    most, rate, toxic = (np.asarray(scored[c], dtype=float) for c in ("most", "rate", "toxic"))
    x, y = _features(most, rate), (toxic > 0).astype(float)
    beta = _logistic(x, y)
    for lone, other in ((1, 2), (2, 1)):
        if beta[other] < 0:  # slopes stay positive or zero
            beta = np.zeros(3)
            beta[[0, lone]] = _logistic(x[:, [0, lone]], y)
            beta[lone] = max(beta[lone], 0.0)
            break
    return lex, beta


def apply(docs: DataFrame, model: tuple[Lexicon, np.ndarray], carry: list[str]) -> DataFrame:
    """``doc`` (a struct of the carried columns), score and the number of matched clauses."""
    sent = docs.sparkSession.sparkContext.broadcast(model)

    def step(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lex, beta = sent.value
        for batch in batches:
            column = batch["text"] if "text" in batch.schema.names else batch["doc"].field("text")
            for piece in words.pieces(column, words.ALNUM, lower=True):
                most, rate, matched = evidence(piece, lex)
                score = 1 / (1 + np.exp(-np.clip(_features(most, rate) @ beta, -30, 30)))
                yield pa.RecordBatch.from_arrays([batch["doc"].slice(piece.lo, piece.hi - piece.lo), pa.array(score), pa.array(matched)], ["doc", "score", "clauses"])

    # A text that is carried is not sent a second time.
    apart = [] if "text" in carry and dict(docs.dtypes)["text"] == "string" else [F.col("text").cast("string").alias("text")]
    given = docs.select(F.struct(*[F.col(c) for c in carry]).alias("doc"), *apart)
    return given.mapInArrow(step, f"doc {given.schema['doc'].dataType.simpleString()}, score double, clauses long")


def report(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted and clauses for every document."""
    scored = apply(docs, fit(docs, labels), ["doc_id"]).select("doc.doc_id", "score", "clauses")
    return scored.select("doc_id", held_out().alias("held_out"), "score", (F.col("score") >= THRESHOLD).cast("int").alias("predicted"), "clauses")


def clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows that are not predicted toxic, with their columns."""
    return apply(docs, fit(docs, labels), docs.columns).where(F.col("score") < THRESHOLD).select("doc.*")
