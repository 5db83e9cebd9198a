import json

import pytest
from pyspark.sql import functions as F

from riskloom.schemas import FEATURE_COLUMNS, RAW
from riskloom.sources import tables

ROWS = "x1,2011,19,6,0.0078125,1,0,3,250000000.5,familyA\nx2,2016,132,44,0.0002,1,0,1,1e8,white\n"
HEADER = "address,year,day,length,weight,count,looped,neighbors,income,label\n"


def write(tmp_path, text, name="raw.csv"):
    (tmp_path / name).write_text(text)
    return str(tmp_path / name)


def test_csv_by_name(spark, tmp_path):
    rows = tables.read_raw_csv(spark, write(tmp_path, HEADER + ROWS)).collect()
    assert rows[0].asDict() == {
        "address": "x1", "year": 2011, "day": 19, "length": 6, "weight": 0.0078125, "count": 1,
        "looped": 0, "neighbors": 3, "income": 250000000.5, "label": "familyA",
    }


@pytest.mark.parametrize("index", ["", "Unnamed: 0"])
def test_index_column_is_dropped_and_shifts_nothing(spark, tmp_path, index):
    numbered = "".join(f"{i},{line}\n" for i, line in enumerate(ROWS.splitlines()))
    with_index = tables.read_raw_csv(spark, write(tmp_path, f"{index},{HEADER}{numbered}", "a.csv"))
    plain = tables.read_raw_csv(spark, write(tmp_path, HEADER + ROWS, "b.csv"))
    assert with_index.schema == RAW and with_index.collect() == plain.collect()


def test_csv_blanks_and_whole_doubles(spark, tmp_path):
    row = tables.read_raw_csv(spark, write(tmp_path, HEADER + "x,2011.0,,5,oops,1,0,2,,white\n")).first()
    assert (row.year, row.day, row.weight, row.income) == (2011, None, None, None)


def test_csv_without_a_column(spark, tmp_path):
    with pytest.raises(ValueError, match="income"):
        tables.read_raw_csv(spark, write(tmp_path, "address,year,day,length,weight,count,looped,neighbors,label\n"))


def test_overwrite(spark, tmp_path, raw_rows):
    path = str(tmp_path / "t")
    tables.write_table(raw_rows, path)
    tables.write_table(raw_rows.limit(2), path)
    assert tables.read_table(spark, path, RAW).count() == 2


def test_live_json_keeps_missing_values(spark, tmp_path):
    live = spark.sql("SELECT timestamp'2024-01-01' AS timestamp, 1.5D AS income, CAST(NULL AS DOUBLE) AS neighbors, 2D AS weight")
    path = str(tmp_path / "live")
    tables.write_live_json(live, path)
    text = spark.read.text(path).first()[0]
    assert json.loads(text)["neighbors"] is None
    assert tables.read_live_json(spark, path).first().asDict() == live.first().asDict()


def test_live_json_array(spark, tmp_path):
    records = [{"timestamp": f"2024-01-0{i}T00:00:00+00:00", "income": i, "neighbors": None, "weight": 0.5} for i in (1, 3, 2)]
    path = write(tmp_path, json.dumps(records, indent=2), "live.json")
    live = tables.read_live_json(spark, path, one_array=True)
    assert live.count() == 3
    assert [r.income for r in tables.newest_first(live).collect()] == [3.0, 2.0, 1.0]


def test_empty_live_data(spark, tmp_path):
    with pytest.raises(RuntimeError, match="no live records"):
        tables.read_live_json(spark, write(tmp_path, "[]", "live.json"), one_array=True)


def test_profile_from_one_json_object(spark, tmp_path):
    entry = {"missing_ratio": 0.0, "mean": 2.0, "std": 1.0, "hist": [1, 2], "bin_edges": [0.0, 1.5, 3.0], "num_bins": 2}
    path = write(tmp_path, json.dumps({"income": entry, "weight": {**entry, "hist": None, "bin_edges": None}}, indent=2), "dist.json")
    rows = {r.feature: r for r in tables.load_profile_json(spark, path).collect()}
    assert rows["income"].hist == [1, 2] and rows["income"].num_bins == 2 and rows["weight"].hist is None


def test_columns_round_trip(spark, tmp_path):
    tables.save_columns(spark, FEATURE_COLUMNS, str(tmp_path / "c"))
    assert tables.load_columns(spark, str(tmp_path / "c")) == FEATURE_COLUMNS


def test_shared_dir_follows_the_setting(spark):
    from riskloom.session import new_path

    assert new_path(spark, "x").startswith(spark.conf.get("spark.checkpoint.dir"))
    assert new_path(spark, "x") != new_path(spark, "x")


def test_broadcast_hint_needs_a_small_count(spark):
    from riskloom.session import BROADCAST_ROWS, broadcast_if_small

    df = spark.range(1).select(F.lit(1).alias("a"))
    assert "hint" in broadcast_if_small(df, 1)._jdf.queryExecution().logical().toString().lower()
    assert broadcast_if_small(df, BROADCAST_ROWS + 1) is df
