import os

import pytest
from pyspark.sql import functions as F

from conftest import same
from fleetwane.plans import jobs
from fleetwane.schema import TELEMETRY_COLUMNS, MissingColumnsError, MissingTableError
from fleetwane.sources import readers, writers


def write(folder, name, text):
    path = os.path.join(folder, name)
    with open(path, "w") as f:
        f.write(text)
    return path


def test_whitespace_text(spark, folder):
    rest = " ".join(str(i + 0.5) for i in range(22))
    path = write(folder, "raw.txt", f"1 1 -0.1 {rest}  \n  1   2 NaN {rest}\n\n\t2 1 x {rest} \n")
    df = readers.read_whitespace_text(spark, path)
    assert tuple(df.columns) == TELEMETRY_COLUMNS
    rows = df.select("unit", "time_in_cycles", "op_setting_1", "sensor_21").collect()
    assert same(rows, [(1, 1, -0.1, None), (1, 2, None, None), (2, 1, None, None)])
    assert df.select("sensor_20").distinct().collect()[0][0] == 21.5
    assert dict(df.dtypes)["unit"] == "bigint"


def test_csv_types_follow_names(spark, folder):
    path = write(folder, "t.csv", "unit,RUL,risk_level,sensor_2_degraded\n1,2.5,High,1\n2,NaN,,0\n")
    df = readers.read_csv_table(spark, path)
    assert same(df.collect(), [(1, 2.5, "High", 1), (2, None, None, 0)])
    assert [t for _, t in df.dtypes] == ["bigint", "double", "string", "int"]


def test_csv_loses_nothing(spark, folder):
    path = write(folder, "n.csv", "unit,time_in_cycles,note,extra,sensor_2\n1,1,hello,7,2.5\nE-7,2,world,NaN,3.5\n")
    df = readers.read_csv_table(spark, path)
    assert dict(df.dtypes) == {"unit": "string", "time_in_cycles": "bigint", "note": "string", "extra": "bigint", "sensor_2": "double"}
    assert same(df.collect(), [("1", 1, "hello", 7.0, 2.5), ("E-7", 2, "world", None, 3.5)])


def test_csv_files_with_other_headers_are_an_error(spark, folder):
    os.mkdir(f"{folder}/mixed.csv")
    write(f"{folder}/mixed.csv", "a.csv", "unit,time_in_cycles,sensor_2\n1,1,2.5\n")
    write(f"{folder}/mixed.csv", "b.csv", "unit,sensor_2,time_in_cycles\n2,7.5,9\n")
    with pytest.raises(Exception, match="(?i)header"):
        readers.read_csv_table(spark, f"{folder}/mixed.csv").collect()


def test_missing_inputs(spark, folder):
    with pytest.raises(MissingTableError):
        readers.read_required(spark, f"{folder}/none.csv")
    with pytest.raises(MissingTableError):
        readers.read_required(spark, f"{folder}/none")
    assert readers.read_or_skip(spark, f"{folder}/none.csv") is None
    path = write(folder, "t.csv", "unit,x\n1,2\n")
    assert readers.read_or_skip(spark, path, ["unit", "RUL"]) is None
    with pytest.raises(MissingColumnsError):
        readers.read_required(spark, path, ["RUL"])


def test_first_existing(spark, folder):
    wrong = write(folder, "wrong.csv", "unit,x\n1,2\n")
    right = write(folder, "right.csv", "unit,RUL\n1,2\n1,2\n")
    found = readers.read_first_existing(spark, [f"{folder}/none.csv", wrong, right])
    assert found.count() == 2
    assert readers.read_first_existing(spark, [wrong]) is None


def test_sensor_features_for_views(spark, folder):
    path = write(folder, "f.csv", "unit,time_in_cycles,sensor_2\n1,1,5\n,2,6\nx,3,7\n")
    assert same(readers.read_sensor_features(spark, path).collect(), [(1, 1, 5.0)])


def test_positional_labels(spark, folder):
    path = write(folder, "rul.txt", "112 \n98\n\n 69\n")
    assert same(readers.read_positional_labels(spark, path).collect(), [(1, 112), (2, 98), (3, 69)])


def test_positional_labels_over_several_blocks(spark, folder):
    path = write(folder, "rul.txt", "".join(f"{i * 3}\n" for i in range(5000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "4096")
    try:
        df = readers.read_positional_labels(spark, path)
        rows = {r.unit: r.RUL for r in df.collect()}
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)
    assert rows == {i + 1: i * 3 for i in range(5000)}


def test_tables_round_trip(spark, folder):
    df = spark.range(50).select((F.col("id") % 5).alias("unit"), F.col("id").alias("time_in_cycles"), (F.col("id") / 4).alias("sensor_2"))
    for name, options in (("a", {}), ("b", {"by_unit": 3}), ("c.csv", {"format": "csv"})):
        path = writers.write_table(df, f"{folder}/new/{name}", **options)
        assert same(readers.read_table(spark, path).collect(), df.collect())
    writers.write_table(df.limit(1), f"{folder}/new/a")
    assert readers.read_table(spark, f"{folder}/new/a").count() == 1


def test_feature_list_and_importances(spark, folder):
    writers.write_feature_columns(spark, ["b", "a"], f"{folder}/names")
    assert writers.read_feature_columns(spark, f"{folder}/names") == ["b", "a"]
    table = spark.createDataFrame([("x", 0.1), ("y", 0.9)], "feature string, importance double")
    writers.write_importances(table, f"{folder}/imp")
    rows = spark.read.option("header", True).csv(f"{folder}/imp").collect()
    assert [r.feature for r in rows] == ["y", "x"]


def test_ingest_skips_missing(spark, folder, capsys):
    line = "1 1 " + " ".join(["0.5"] * 24) + "\n"
    path = write(folder, "train.txt", line)
    written = jobs.ingest(spark, {"train": path, "test": f"{folder}/none.txt"}, f"{folder}/out")
    assert list(written) == ["train"] and spark.read.parquet(written["train"]).count() == 1
    assert "skipped test" in capsys.readouterr().out


def test_cached(spark):
    df = readers.cached(spark.range(3))
    assert df.is_cached
    df.unpersist()


@pytest.mark.parametrize(
    "fields,kind,values",
    [
        (["true", "False", "NaN"], "boolean", [True, False, None]),
        (["9007199254740993", "-5", ""], "bigint", [9007199254740993, -5, None]),
        (["123456789012345678901234567890", "7"], "decimal(38,0)", ["123456789012345678901234567890", "7"]),
        (["9007199254740993", "0.25"], "decimal(38,2)", ["9007199254740993.00", "0.25"]),
        (["12345678901234567890123456789012345678", "0.5"], "string", ["12345678901234567890123456789012345678", "0.5"]),
        (["1", "2.5", "nan", "1e3", "inf"], "double", [1.0, 2.5, None, 1000.0, float("inf")]),
        (["007", "12"], "string", ["007", "12"]),
        (["true", "1"], "string", ["true", "1"]),
        (["1d", "2f"], "string", ["1d", "2f"]),
        (["2024-02-29", "2023-01-31"], "date", ["2024-02-29", "2023-01-31"]),
        (["2023-02-29", "2023-01-31"], "string", ["2023-02-29", "2023-01-31"]),
        (["2024-02-29 10:11:12.5", "2023-01-31T00:00:00"], "timestamp_ntz", ["2024-02-29 10:11:12.500000", "2023-01-31 00:00:00"]),
        (["2024-02-29", "3"], "string", ["2024-02-29", "3"]),
        (["", "NaN"], "double", [None, None]),
        (["0.1", "0.30000000000000004"], "double", [0.1, 0.30000000000000004]),
    ],
)
def test_csv_types(spark, tmp_path, fields, kind, values):
    for i, field in enumerate(fields):  # a file each: what is seen is merged
        (tmp_path / f"{i}.csv").write_text(f"unit,other thing\n{i},{field}\n")
    df = readers.read_csv_table(spark, str(tmp_path))
    assert dict(df.dtypes) == {"unit": "bigint", "other thing": kind}
    got = [r["other thing"] for r in df.orderBy("unit").collect()]
    assert got == values or [None if v is None else str(v) for v in got] == values


def test_csv_columns_of_the_data_model_keep_their_type(spark, tmp_path):
    (tmp_path / "a.csv").write_text("unit,sensor_2,RUL,failure_binary\n1,5,7,0\n")
    df = readers.read_csv_table(spark, str(tmp_path))
    assert [t for _, t in df.dtypes] == ["bigint", "double", "double", "int"]
