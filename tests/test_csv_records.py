"""Quoted CSV over many splits equals the reader that gives a file to one task."""

import numpy as np
import pytest
from pyspark.sql import types as T

from vitrine.sources import csv_records as C
from vitrine.sources.sinks import CSV, CSV_BLANKS

SCHEMA = T.StructType([T.StructField("a", T.StringType()), T.StructField("b", T.DoubleType()), T.StructField("c", T.StringType())])


@pytest.fixture
def small_splits(spark):
    names = {"spark.sql.files.maxPartitionBytes": "97", "spark.sql.files.openCostInBytes": "1", "spark.sql.files.minPartitionNum": "1"}
    before = {k: spark.conf.get(k, None) for k in names}
    for k, v in names.items():
        spark.conf.set(k, v)
    yield
    for k, v in before.items():
        spark.conf.unset(k) if v is None else spark.conf.set(k, v)


def rows(df):
    return sorted(map(repr, df.collect()))


def whole(spark, path, header=True):
    return spark.read.option("header", header).options(**CSV, multiLine=True).schema(SCHEMA).csv(path)


def test_splits_inside_fields(spark, tmp_path, small_splits):
    """Splits of 97 bytes: most begin inside a field, many hold no record start at all."""
    rng = np.random.default_rng(9)
    pieces = ["x", "\n", '"', ",", '""', "é", " ", "\n\n", "line\nbreak", '",\n"', "word " * 30, "\r\n"]
    data = [("".join(rng.choice(pieces, rng.integers(0, 14))) + "!", float(i), str(i)) for i in range(300)]
    path = str(tmp_path / "csv")
    spark.createDataFrame(data, SCHEMA).repartition(3).write.option("header", True).options(**CSV).csv(path)
    assert spark.read.text(path).rdd.getNumPartitions() > 100
    got = C.read_csv(spark, path, SCHEMA, **CSV_BLANKS)
    assert rows(got) == rows(whole(spark, path)) == sorted(repr(T.Row(*SCHEMA.names)(*d)) for d in data)


def test_files_as_others_write_them(spark, tmp_path, small_splits):
    texts = {"crlf": 'a,b,c\r\n"x\r\ny",1,z\r\n,2,\r\n', "bare": 'a,b,c\nx,1,"y"\n\n\nz,2,w', "empty": "", "head": "a,b,c\n",
             "long": 'a,b,c\n"' + "q\n" * 400 + '",5,end\nlast,6,row\n'}
    for name, text in texts.items():
        path = tmp_path / f"{name}.csv"
        path.write_bytes(text.encode())
        # the other reader turns line ends inside fields of a CRLF file into LF; here fields stay as they are
        got = [repr(T.Row(*SCHEMA.names)(*[v.replace("\r\n", "\n") if isinstance(v, str) else v for v in r])) for r in C.read_csv(
            spark, str(path), SCHEMA).collect()]
        assert sorted(got) == rows(whole(spark, str(path))), name
    assert {r.a for r in C.read_csv(spark, str(tmp_path / "crlf.csv"), SCHEMA).collect()} == {"x\r\ny", None}
    folder = str(tmp_path / "*.csv")
    assert C.read_csv(spark, folder, SCHEMA).count() == whole(spark, folder).count() == 6
    headless = C.read_csv(spark, str(tmp_path / "bare.csv"), T.StructType([T.StructField(k, T.StringType()) for k in "abc"]), header=False)
    assert headless.count() == 3


def test_malformed_records_are_errors(spark, tmp_path):
    path = tmp_path / "bad.csv"
    path.write_text("a,b,c\nx,not a number,z\n")
    with pytest.raises(Exception, match="MALFORMED|malformed|Malformed"):
        C.read_csv(spark, str(path), SCHEMA).collect()
    kept = C.read_csv(spark, str(path), SCHEMA, mode="PERMISSIVE").first()
    assert (kept.a, kept.b, kept.c) == ("x", None, "z")


def test_lines_are_not_shuffled(spark, tmp_path):
    """The states of the splits are a small written table: lines stay in the tasks that read them."""
    path = str(tmp_path / "csv")
    spark.createDataFrame([("x\ny", 1.0, "z")] * 50, SCHEMA).coalesce(1).write.option("header", True).options(**CSV).csv(path)
    df = C.csv_records(spark, path)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in plan and "SortMergeJoin" not in plan
    assert df.count() == 51 and df.where("first").count() == 1
