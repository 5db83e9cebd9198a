"""Arrays cut into many byte ranges against the reader that takes a file in one task."""

import json
import random

import pytest
from pyspark.sql import functions as F

from riskloom.schemas import LIVE
from riskloom.sources import json_array, tables

NESTED = "id long, note string, box struct<a:long,b:array<struct<c:string>>>"


@pytest.fixture
def small_ranges(spark):
    before = {n: spark.conf.get(n, None) for n in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes", "spark.sql.files.minPartitionNum")}
    for name, value in zip(before, ("97", "1", "1")):
        spark.conf.set(name, value)
    yield
    for name, value in before.items():
        spark.conf.unset(name) if value is None else spark.conf.set(name, value)


def odd_text(rng):
    return "".join(rng.choice(['{', '}', '[', ']', '"', "\\", ",", "a", "é", "\n", " ", "{}", '\\"', "}]"]) for _ in range(rng.randrange(12)))


@pytest.mark.parametrize("layout", [{}, {"indent": 1}, {"separators": (",", ":")}])
def test_braces_and_quotes_inside_texts(spark, small_ranges, tmp_path, layout):
    rng = random.Random(7)
    for file in range(2):
        records = [{"id": 100 * file + i, "note": odd_text(rng), "box": {"a": i, "b": [{"c": odd_text(rng)} for _ in range(i % 4)]} if i % 3 else None} for i in range(60)]
        (tmp_path / f"{file}.json").write_text(json.dumps(records, ensure_ascii=file == 0, **layout))
    got = json_array.read_json_array(spark, str(tmp_path), spark.createDataFrame([], NESTED).schema)
    assert json_array.chunks(spark, str(tmp_path)).rdd.getNumPartitions() > 20
    expected = spark.read.schema(NESTED).option("multiLine", True).json(str(tmp_path))
    assert sorted(map(str, got.collect())) == sorted(map(str, expected.collect())) and got.count() == 120


def test_live_file(spark, small_ranges, tmp_path):
    rows = [{"timestamp": f"2024-01-0{1 + i % 9}T10:00:00Z", "income": i * 1.5, "neighbors": None if i % 4 else i, "weight": 1e-9, "more": "x"} for i in range(50)]
    (tmp_path / "live.json").write_text(json.dumps(rows))
    got, one_task = (tables.read_live_json(spark, str(tmp_path), one_array=how) for how in ("ranges", True))
    assert got.schema == one_task.schema
    assert sorted(map(str, got.collect())) == sorted(map(str, one_task.collect())) and got.count() == 50


@pytest.mark.parametrize("text, rows", [("[]", 0), ("[ ]\n", 0), ('[{"income": 2}]', 1), ('\n[\n{}\n,\n{"income":1}\n]\n', 2), ("", 0)])
def test_short_files(spark, tmp_path, text, rows):
    (tmp_path / "a.json").write_text(text)
    assert json_array.read_json_array(spark, str(tmp_path), LIVE).count() == rows


def test_text_is_searched_once(spark, tmp_path):
    """Of the whole text a chunk's escapes are taken away and its marks kept; strings are found among the marks alone."""
    (tmp_path / "a.json").write_text("[]")
    plan = json_array.chunks(spark, str(tmp_path))._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("regexp_replace(value") + plan.count("regexp_replace(text") <= 2


def test_written_arrays_are_json(spark, tmp_path):
    """Every file is one array, with copies of a record, one record, or none; it takes one shuffle and no sort of texts."""
    for n in (0, 1, 500):
        rows = spark.range(n).select(F.when(F.col("id") % 5 != 0, F.col("id") % 40).alias("a"), F.lit('x"},{[\\').alias("b")).repartition(3)
        json_array.write_json_array(rows, str(tmp_path / str(n)), "a", files=3)
        found = [json.loads(f.read_text()) for f in (tmp_path / str(n)).rglob("part-*.txt")]
        assert len(found) == 3
        assert sorted(str(r) for f in found for r in f) == sorted(str(r.asDict()) for r in rows.collect())
