"""Scores against a plain PPM coder and a plain word count, and held-out accuracy."""

import math
import re
import zlib
from collections import Counter, defaultdict

import pytest

from riskloom.llm import ppm

TEXTS = [
    "the cat sat on the mat", "The  dog sat\ton the log\n", "", None, "éa été là", "a", "zzzz yyyy xxxx",
    "the cat and the dog sat on the mat and on the log", "the cat sat on the mat", " \n ", "q" * 300, "0 1 2 3",
]


def words_of(text):
    lowered = (text or "").translate({c: c + 32 for c in range(65, 91)})
    return re.findall(r"[^\x20\x09-\x0D]+", lowered)


def training(i, fold, folds):
    return zlib.crc32(str(i).encode()) % folds != fold


def stream(text):
    return " ".join(words_of(text)).encode() + b"\n"


def plain_ppm(train):
    counts = [defaultdict(Counter) for _ in range(ppm.ORDER + 1)]
    for text in train:
        padded = b"\n" * ppm.ORDER + stream(text)
        for i in range(ppm.ORDER, len(padded)):
            for k in range(ppm.ORDER + 1):
                counts[k][padded[i - k : i]][padded[i]] += 1

    def score(text):
        padded, total = b"\n" * ppm.ORDER + stream(text), 0.0
        for i in range(ppm.ORDER, len(padded)):
            gone, p = set(), 1.0
            for k in range(ppm.ORDER, -1, -1):
                seen = counts[k].get(padded[i - k : i])
                if not seen:
                    continue
                left = {s: 2 * n - 1 for s, n in seen.items() if s not in gone}
                if padded[i] in left:
                    p *= left[padded[i]] / (sum(left.values()) + len(left))
                    break
                if left:
                    p *= len(left) / (sum(left.values()) + len(left))
                gone |= set(seen)
            else:
                p /= 256 - len(gone)
            total += math.log10(p)
        return total

    return score


@pytest.mark.parametrize("nodes", [ppm.NODES, 20])
def test_equals_plain(spark, nodes):
    rows = [(i, t, "src") for i, t in enumerate(TEXTS * 2)]
    got = {r["doc_id"]: r for r in ppm.score(spark.createDataFrame(rows, "doc_id long, text string, tag string"), nodes=nodes, vocabulary_size=nodes).collect()}
    train = [t for i, t, _ in rows if training(i, 2, 7)]
    tokens = Counter(w for t in train for w in [*words_of(t), ""])
    n, v, plain = sum(tokens.values()), len(tokens), plain_ppm(train)
    assert len(got) == len(rows)
    for i, t, _ in rows:
        own, r = [*words_of(t), ""], got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (not training(i, 2, 7), len(own), sum(tokens[w] > 0 for w in own), n)
        assert r["base_score"] == pytest.approx(sum(math.log10((tokens[w] + 1) / (n + v + 1)) for w in own), rel=1e-9)
        assert r["score"] == pytest.approx(plain(t), rel=1e-5)


def test_empty_table_and_no_training(spark):
    assert ppm.score(spark.createDataFrame([], "doc_id long, text string")).count() == 0
    held = [i for i in range(40) if not training(i, 2, 7)]
    rows = ppm.score(spark.createDataFrame([(i, "ab") for i in held], "doc_id long, text string")).collect()
    assert {(r["n_known"], r["train_tokens"], r["base_score"]) for r in rows} == {(0, 0, 0.0)}
    assert all(r["score"] == pytest.approx(-3 * math.log10(256)) for r in rows)


def test_null_id_and_repeated_rows(spark):
    rows = ppm.score(spark.createDataFrame([(None, "a b"), (None, "a b"), (5, "a b")], "doc_id long, text string"), nodes=3, vocabulary_size=3).collect()
    assert len(rows) == 3 and len({(r["n_tokens"], r["n_known"], r["base_score"]) for r in rows}) == 1


def test_held_out_accuracy(spark):
    """Better than word counts, though these give all unseen words one probability and PPM spells them out."""
    docs = spark.read.parquet("/root/testdata/sf0.1/documents.parquet")
    held = ppm.score(docs).where("held_out").groupBy().agg({"score": "sum", "base_score": "sum"}).first()
    assert held["sum(score)"] > held["sum(base_score)"]
