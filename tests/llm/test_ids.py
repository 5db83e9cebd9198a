"""Ids of other types than long give the same rows; one document may repeat a passage without end."""

import hashlib
from collections import Counter

import pytest

from riskloom.llm import exact_dedup, minhash, ppm, set_join, substrings

PASSAGE = " ".join(f"w{i}" for i in range(30))


def rows():
    texts = [PASSAGE + f" tail{i % 3} of text {i}" for i in range(6)] + ["a b c", "a b c", None, "", PASSAGE[::-1] * 2]
    return [(i * 7 % 11 if i != 4 else None, t) for i, t in enumerate(texts)]


def as_name(i):
    return None if i is None else f"doc-{i:03d}"


@pytest.mark.parametrize("work, ids", [
    (substrings.dedup_report, ["doc_id"]), (minhash.near_groups, ["doc_id", "component_id"]), (set_join.similar_groups, ["doc_id", "component_id"]),
    (exact_dedup.exact_groups, ["doc_id", "keep_id"]),
], ids=["op2", "op9", "op13", "op4"])
def test_ids_of_any_type(spark, work, ids):
    want = work(spark.createDataFrame(rows(), "doc_id long, text string"))
    number = work(spark.createDataFrame(rows(), "doc_id int, text string"))
    name = work(spark.createDataFrame([(as_name(i), t, 1) for i, t in rows()], "doc_id string, text string, number int"))
    assert number.schema["doc_id"].dataType.simpleString() == "int" and name.schema["doc_id"].dataType.simpleString() == "string"
    assert want.columns == number.columns == name.columns
    plain = Counter(map(tuple, want.collect()))
    assert Counter(map(tuple, number.collect())) == plain
    at = [want.columns.index(c) for c in ids]
    assert Counter(map(tuple, name.collect())) == Counter(tuple(as_name(v) if i in at else v for i, v in enumerate(r)) for r in plain.elements())


def test_scores_of_named_documents(spark):
    scored = ppm.score(spark.createDataFrame([(as_name(i), t) for i, t in rows()], "doc_id string, text string")).collect()
    assert Counter(r["doc_id"] for r in scored) == Counter(as_name(i) for i, _ in rows())


def test_a_passage_repeated_without_end_in_one_document(spark, monkeypatch):
    again = " ".join([PASSAGE] * 100_000)
    docs = spark.createDataFrame([(1, "first " + again), (2, again + " x y"), (3, "z " + PASSAGE)], "doc_id long, text string")
    seen = []
    shard_rows = substrings.shard_rows
    monkeypatch.setattr(substrings, "shard_rows", lambda *a: seen.append(shard_rows(*a)) or seen[-1])
    got = {r["doc_id"]: tuple(r)[1:] for r in substrings.dedup_report(docs).collect()}
    assert got[1][:2] == (3_000_001, 0) and got[2][:2] == (3_000_002, 3_000_000) and got[3][:2] == (31, 30)
    assert got[2][2] == hashlib.sha256(b"x y").hexdigest() and got[3][2] == hashlib.sha256(b"z").hexdigest()
    most = seen[0].groupBy("key").count().agg({"count": "max"}).collect()[0][0]
    assert most is None or most <= substrings.HOT_SEGMENTS
