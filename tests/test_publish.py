"""A table is published only if the job that wrote it saw no fault."""

import datetime as dt

import pytest
from pyspark.sql import types as T

from areapanel.operators.checks import Gate, PipelineCheckError
from areapanel.sinks import tables as K

SCHEMA = T.StructType([T.StructField("ward", T.StringType(), False), T.StructField("date", T.DateType(), False),
                       T.StructField("v", T.DoubleType(), False)])


def frame(spark, rows):
    return spark.createDataFrame([(k, dt.date(2020, m, 1) if m else None, v) for k, m, v in rows], "ward string, date date, v double")


GOOD = [("A", 1, 1.0), ("A", 2, 2.0), ("A", 3, 3.0), ("B", 1, 1.0), ("B", 2, 1.5), ("C", 7, 9.0)]


@pytest.mark.parametrize("rows, check", [
    (GOOD + [("D", 1, None), ("D", 2, 1.0)], "nulls"), (GOOD + [("A", 3, 3.0)], "unique"), (GOOD + [("A", 5, 3.0)], "timeseries"),
    (GOOD + [(None, 1, 3.0)], "nulls"), ([("A", 2, 1.0), ("A", 3, 1.0)], "timeseries")])
def test_a_fault_leaves_the_old_table(spark, tmp_path, rows, check):
    path = str(tmp_path / "t")
    assert K.publish(frame(spark, GOOD), path, Gate(SCHEMA, "ward", start="2020-01-01"))["single"] == 1
    with pytest.raises(PipelineCheckError) as e:
        K.publish(frame(spark, rows).repartition(3), path, Gate(SCHEMA, "ward", start="2020-01-01"))
    assert e.value.check == check
    assert sorted(map(tuple, K.read_table(spark, path).select("ward", "date", "v").collect())) == sorted(
        map(tuple, frame(spark, GOOD).collect()))
    assert [p.name for p in tmp_path.iterdir()] == ["t"]


def test_replaced_whole_and_checked_before_any_job(spark, tmp_path):
    path = str(tmp_path / "t")
    K.publish(frame(spark, GOOD), path, Gate(SCHEMA, "ward"), parts=2)
    report = K.publish(frame(spark, [("Z", 4, 1.0), ("Z", 5, 1.0)]), path, Gate(SCHEMA, "ward"), parts=2)
    assert report == {"rows": 2, "single": 0, "out_of_line": 0, "repeated": 0, "nulls": {}}
    assert {r.ward for r in K.read_table(spark, path).collect()} == {"Z"}
    with pytest.raises(PipelineCheckError):
        K.publish(frame(spark, GOOD).drop("v"), path, Gate(SCHEMA, "ward"))
    assert K.publish(frame(spark, []), path, Gate(SCHEMA, "ward"))["rows"] == 0


def test_metrics_come_with_the_write(spark, tmp_path):
    """The rows are computed once: a counter in them shows each row one time."""
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = frame(spark, GOOD).mapInArrow(count, "ward string, date date, v double")
    K.publish(df, str(tmp_path / "t"), Gate(SCHEMA, "ward"))
    assert seen.value == len(GOOD)
