import os

import pytest
from conftest import SF001
from pyspark.sql import functions as F

from sparkcivic.session import scratch_path
from sparkcivic.sources import (Source, ingest, read_csv, read_csv_checked, read_numbered_lines, read_parquet, read_text, write_csv,
                                write_parquet, write_text)
from sparkcivic.sources.schemas import CENSUS, INCOME
from sparkcivic.streaming.incremental import band_counts_stream, latest


def test_csv_round_trip_with_quotes_and_nulls(spark):
    df = spark.createDataFrame([("a, b", 1.5), ('say "hi"', None), ("", 2.0), (None, 3.0)],
                               "t string, v double")
    path = write_csv(df, scratch_path(spark, "t-csv"))
    back = read_csv(spark, path, schema="t string, v double")
    got = sorted([tuple(r) for r in back.collect()], key=str)
    # quoted commas and doubled quotes survive; with the default CSV options an
    # empty string reads back as NULL
    assert got == sorted([("a, b", 1.5), ('say "hi"', None), (None, 2.0), (None, 3.0)], key=str)


def test_csv_single_file_and_no_header(spark):
    df = spark.range(100).select(F.col("id").cast("string").alias("zip"), (F.col("id") / 10).alias("hh"))
    path = write_csv(df, scratch_path(spark, "one"), header=False, single_file=True)
    files = [f for f in spark.sparkContext.wholeTextFiles(path).keys().collect() if "part-" in f]
    assert len(files) == 1
    assert read_csv(spark, path, schema="zip string, hh double", header=False).count() == 100


def test_text_sink_refuses_existing_path(spark):
    df = spark.createDataFrame([("x",)], "value string")
    path = write_text(df, scratch_path(spark, "txt"))
    assert [r.value for r in read_text(spark, path).collect()] == ["x"]
    with pytest.raises(Exception):
        write_text(df, path)
    with pytest.raises(ValueError):
        write_text(spark.createDataFrame([("a", "b")], "x string, y string"), scratch_path(spark, "t2"))


def test_ingest_reports_failures_and_continues(spark):
    raw = scratch_path(spark, "raw")
    write_csv(spark.createDataFrame([("00001", 2.5)], "zip string, hh double"), f"{raw}/census")
    write_csv(spark.createDataFrame([("00001", "$1,000")], "zip string, inc string"), f"{raw}/income")
    out = scratch_path(spark, "out")
    status = ingest(spark, [Source("census", f"{raw}/census", "csv", CENSUS),
                            Source("missing", f"{raw}/nope", "csv", INCOME),
                            Source("income", f"{raw}/income", "csv", INCOME)], out)
    rows = {r.source: r for r in status.collect()}
    assert rows["census"].ok and rows["census"].rows == 1
    assert rows["income"].ok and rows["income"].rows == 1
    assert not rows["missing"].ok and rows["missing"].rows is None and rows["missing"].error == "PATH_NOT_FOUND"
    assert spark.read.parquet(f"{out}/income").count() == 1


def test_streaming_band_counts_accumulate_over_files(spark):
    src = scratch_path(spark, "stream-src")
    schema = "crime string, age int"
    write_parquet(spark.createDataFrame([("1-URGENT", 10), ("2-HIGH", 30)], schema), f"{src}/a")
    write_parquet(spark.createDataFrame([("1-urgent", 70), ("1-URGENT", 20), ("1-URGENT", None)], schema),
                  f"{src}/b")
    out = scratch_path(spark, "stream-out")
    df_schema = spark.createDataFrame([], schema).schema
    h = band_counts_stream(spark, f"{src}/*", df_schema, out, scratch_path(spark, "stream-ckpt"),
                           pattern="(?i)urgent", max_files_per_trigger=1)
    h.awaitTermination()
    got = {r.age_group: r["count"] for r in spark.read.parquet(out).collect()}
    assert got == {"Children": 1, "Elderly": 1, "Young Adults": 1}


def test_scratch_scope_deletes_its_tables(spark):
    from sparkcivic.session import materialize, scratch_scope
    with scratch_scope(spark) as made:
        df = materialize(spark.range(100), "scope-test")
        assert df.count() == 100
        with scratch_scope(spark) as inner:
            write_text(spark.createDataFrame([("a",)], "value string"), scratch_path(spark, "scope-inner"))
        assert len(inner) == 1 and not os.path.exists(inner[0].removeprefix("file:"))
        assert len(made) == 2 and os.path.exists(made[0].removeprefix("file:"))
    assert not any(os.path.exists(p.removeprefix("file:")) for p in made)


def test_a_failing_source_leaves_the_old_table(spark):
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "out")
    write_csv(spark.createDataFrame([("00001", 2.5)], "zip string, hh double"), f"{raw}/census")
    assert ingest(spark, [Source("s", f"{raw}/census", "csv", CENSUS)], out).first().ok
    boom = lambda df: df.withColumn("hh", F.raise_error(F.lit("late failure")))  # noqa: E731  fails while writing
    status = ingest(spark, [Source("s", f"{raw}/census", "csv", CENSUS, transform=boom), Source("t", f"{raw}/census", "csv", CENSUS)], out).collect()
    assert [(r.source, r.ok) for r in status] == [("s", False), ("t", True)] and "late failure" in status[0].message
    assert [tuple(r) for r in spark.read.parquet(f"{out}/s").collect()] == [("00001", 2.5)]
    hidden = [f for f in os.listdir(out) if f.startswith("_staged") and os.listdir(f"{out}/{f}")]
    assert not hidden
    with pytest.raises(ValueError):
        ingest(spark, [Source("a", raw), Source("a", raw)], out)


def test_bad_cells_and_lines_are_counted_and_kept(spark):
    raw, out = scratch_path(spark, "raw"), scratch_path(spark, "out")
    spark.createDataFrame([("zip,hh,n",), ("1,2.5,3",), ("2,many,4",), ("3,1.5,",), ("4,x,y",), ("5,1.0",), ("6,1.0,2,9",)], "value string").coalesce(1).write.text(raw)
    schema = "zip string, hh double, n int"
    checked = {r.zip: r for r in read_csv_checked(spark, raw, schema).collect()}
    assert {z: r._bad_cells for z, r in checked.items()} == {"1": [], "2": ["hh"], "3": [], "4": ["hh", "n"], "5": [], "6": []}
    assert checked["2"].hh is None and checked["2"]._text_hh == "many" and checked["5"]._bad_line == "5,1.0" and checked["6"]._bad_line
    from pyspark.sql.types import StructType
    for _ in range(2):  # a second load replaces the rejected rows as well
        row = ingest(spark, [Source("s", raw, "csv", StructType.fromDDL(schema))], out).first()
        assert (row.rows, row.rejected, row.ok) == (2, 4, True)
        assert {(r.zip, r.hh, r.n) for r in spark.read.parquet(f"{out}/_rejected/s").collect()} == {
            ("2", "many", "4"), ("4", "x", "y"), ("5", "1.0", None), ("6", "1.0", "2")}
    assert sorted(r.zip for r in spark.read.parquet(f"{out}/s").collect()) == ["1", "3"]


def test_parquet_paths_of_different_layout(spark):
    a, b = scratch_path(spark, "a"), scratch_path(spark, "b")
    write_parquet(spark.createDataFrame([(1, 5)], "id int, n int"), a)
    write_parquet(spark.createDataFrame([(2, "x", "7")], "id long, x string, n string"), b)
    for paths in ([a, b], [b, a]):
        got = read_parquet(spark, paths, schema="id bigint, x string, n int")
        assert sorted((tuple(r) for r in got.collect()), key=str) == [(1, None, 5), (2, "x", 7)]
        assert sorted(read_parquet(spark, paths, ["id", "x"], schema="id bigint, x string").columns) == ["id", "x"]
        with pytest.raises(TypeError, match="column n"):  # while planning
            read_parquet(spark, paths)
    with pytest.raises(ValueError, match="nowhere"):
        read_parquet(spark, [a, b], schema="id bigint, nowhere int")
    spark.createDataFrame([(3, "y")], "id int, z string").write.mode("append").parquet(a)
    assert set(read_parquet(spark, a, merge_schema=True).columns) == {"id", "n", "z"}


def test_ordered_output_in_parts_and_in_one_file(spark):
    df = spark.range(5000).select((F.col("id") * 7919 % 5000).cast("string").alias("value"))
    order = [F.col("value").cast("int").desc()]
    for kw in ({"parts": 6}, {"single_file": True}):
        path = write_text(df, scratch_path(spark, "ordered"), order_by=order, **kw)
        lines = {r.line: r.value for r in read_numbered_lines(spark, path).collect()}
        assert [lines[k] for k in range(1, 5001)] == [str(v) for v in range(4999, -1, -1)]
        files = [f for f in os.listdir(path) if f.startswith("part-")]
        assert len(files) == (6 if "parts" in kw else 1)


def test_balanced_files_split_a_hot_value_and_merge_small_ones(spark):
    old = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "256k")
    try:
        df = spark.range(60_000, numPartitions=12).select(
            F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("v"), F.col("id") % 20)).alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("x"))
        count = lambda p: {d: len([f for f in os.listdir(f"{p}/{d}") if f.endswith(".parquet")]) for d in os.listdir(p) if d.startswith("k=")}
        plain = count(write_parquet(df, scratch_path(spark, "plain"), partition_by=["k"]))
        even = count(write_parquet(df, scratch_path(spark, "even"), partition_by=["k"], balanced=True))
        assert even["k=hot"] > 1 and sum(even.values()) < sum(plain.values()) / 2
        assert sorted(n for d, n in even.items() if d != "k=hot")[10] <= 2  # but for those that were dealt with the hot one
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", old)
    with pytest.raises(ValueError):
        write_parquet(df, scratch_path(spark, "x"), balanced=True, order_by=["k"])


def test_stream_keeps_the_last_epochs(spark, tmp_path):
    for i in range(5):
        spark.createDataFrame([(30, "Agg Assault aggravated assault")], "age int, crime string").coalesce(1).write.parquet(str(tmp_path / f"src/part={i}"))
    out = str(tmp_path / "out")
    q = band_counts_stream(spark, str(tmp_path / "src" / "*"), spark.read.parquet(str(tmp_path / "src" / "part=0")).schema, out,
                           str(tmp_path / "ckpt"), pattern="(?i)aggravated assault", max_files_per_trigger=1, kept_epochs=2)
    q.awaitTermination()
    assert sorted(p.name for p in (tmp_path / "out").iterdir()) == ["epoch=3", "epoch=4"]
    assert [tuple(r) for r in latest(spark, out).collect()] == [("Adults", 5)]
    with pytest.raises(ValueError, match="kept_epochs"):
        band_counts_stream(spark, out, None, out, out, kept_epochs=0)


def test_stream_query_runs_one_batch_an_era(spark, tmp_path):
    """However many files an era has: batches times state partitions would grow as the square of the input."""
    from sparkcivic.session import scratch_scope
    from sparkcivic.streaming import incremental
    for name in ("orders", "customer"):
        spark.read.parquet(f"{SF001}/{name}.parquet").write.parquet(str(tmp_path / f"{name}.parquet"))
    kept = spark.conf.get("spark.sql.adaptive.coalescePartitions.enabled")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")  # so that an era has several files
    join = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        with scratch_scope(spark) as paths:
            rows = incremental.q_age_bands_stream(spark, str(tmp_path)).collect()
            src, out = (next(p for p in paths if f"/{n}-" in p) for n in ("incident-stream", "band-stream-out"))
            assert all(len([f for f in os.listdir(f"{src.removeprefix('file:')}/era={k}") if f.endswith(".parquet")]) > 1 for k in (1, 2))
            assert sorted(f for f in os.listdir(out.removeprefix("file:")) if "=" in f) == ["epoch=0", "epoch=1"]
        from sparkcivic.plans import analyses, fixtures as fx
        want = analyses.band_counts(fx.incidents(spark, SF001), "age", "crime", fx.CRIME_PATTERN).collect()
        assert sorted(rows) == sorted(want) and len(want) > 1
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", kept)
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", join)
