import json
from datetime import datetime

import pytest

from riskloom.operators import requests as r
from riskloom.operators.runs import current_run, resolve_run
from riskloom.schemas import NUMERIC_COLUMNS, REQUEST

WHOLE = {"year": 2013, "day": 77, "length": 4, "weight": 0.25, "count": 2, "looped": 0, "neighbors": 9, "income": 1.5}


def decoded(spark, *bodies):
    texts = [(i, b if isinstance(b, str) or b is None else json.dumps(b)) for i, b in enumerate(bodies)]
    return r.decode(spark.createDataFrame(texts, "id int, body string")).orderBy("id").collect()


def test_whole_request(spark):
    row, = decoded(spark, WHOLE)
    assert row.reason is None and row.missing_fields == []
    assert {c: row[c] for c in NUMERIC_COLUMNS} == WHOLE


@pytest.mark.parametrize("body", ["<none>", "", None, "null", '{"year": 2013', "{'year' 1}"])
def test_invalid_json(spark, body):
    row, = decoded(spark, body)
    assert row.reason == r.INVALID_JSON and row.missing_fields is None


def test_missing_fields_are_listed_in_order(spark):
    some = {k: v for k, v in WHOLE.items() if k not in ("income", "day")}
    a, b, c = decoded(spark, some, {}, [1, 2])
    assert a.reason == b.reason == c.reason == r.MISSING_FIELDS
    assert a.missing_fields == ["day", "income"]
    assert b.missing_fields == c.missing_fields == NUMERIC_COLUMNS


def test_null_counts_as_present_and_unknown_fields_are_ignored(spark):
    row, = decoded(spark, {**WHOLE, "income": None, "color": "red", "address": "x"})
    assert row.reason is None and row.income is None


def test_numbers_in_other_shapes(spark):
    a, b = decoded(spark, {**WHOLE, "year": 2013.0, "count": 2.5, "day": -10}, {**WHOLE, "weight": "heavy"})
    assert (a.reason, a.year, a["count"], a.day) == (None, 2013, 2.5, -10.0)
    assert b.reason == r.INVALID_VALUES


def test_every_request_is_accepted_or_rejected(spark):
    texts = [(json.dumps(WHOLE),), ("x",), ("{}",)]
    out = r.decode(spark.createDataFrame(texts, "body string"))
    assert r.accepted(out).count() == 1 and r.rejected(out).count() == 2
    assert r.accepted(out).select(*NUMERIC_COLUMNS).schema == REQUEST
    assert set(r.rejected(out).columns) == {"body", "missing_fields", "reason"}


RUNS = "run_id string, run_name string, end_time timestamp"


def at(day):
    return datetime(2024, 1, day)


def test_current_run(spark):
    log = spark.createDataFrame([
        ("a1", "ended", at(1)), ("a2", "ended", at(3)), ("a3", "ended", at(2)),
        ("b1", "open", at(9)), ("b2", "open", None),
        ("c1", "torn", None), ("c2", "torn", None),
        ("d1", "tied", at(5)), ("d2", "tied", at(5)),
    ], RUNS)
    got = {x.run_name: (x.run_id, x.reason) for x in current_run(log).collect()}
    assert got == {
        "ended": ("a2", None), "open": ("b2", None), "torn": (None, "multiple_unfinished_runs"), "tied": ("d2", None),
    }
    assert resolve_run(log, "ended") == "a2"
    with pytest.raises(RuntimeError, match="2 unfinished"):
        resolve_run(log, "torn")
    with pytest.raises(RuntimeError, match="No run"):
        resolve_run(log, "other")
