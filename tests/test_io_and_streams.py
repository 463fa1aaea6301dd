"""Sources, sinks and restartable streams."""

from __future__ import annotations

import json

import pytest
from pyspark.sql import functions as F

from corpusloom.operators.composites import mix_file
from corpusloom.sources import io
from corpusloom.streaming import incremental as inc


def test_jsonl_modes(spark, tmp_path):
    (tmp_path / "b.jsonl").write_text('{"id": "x", "n": 1}\n\n{broken\n{"id": "y", "n": null}\n')
    path = str(tmp_path / "b.jsonl")
    assert sorted(r.id for r in io.read_jsonl(spark, path, "id string, n int", "skip").collect()) == ["x", "y"]
    assert io.read_jsonl(spark, path, "id string, n int", "keep").cache().where("_corrupt_record is not null").count() == 1
    with pytest.raises(Exception, match="(?i)malformed|FAILFAST|parse"):
        io.read_jsonl(spark, path, "id string, n int").collect()
    assert [r.seq for r in io.with_line_numbers(spark, path).orderBy("seq").collect()] == [0, 2, 3]


def test_jsonl_round_trip(spark, tmp_path):
    df = spark.createDataFrame([(1, "ünï 🎛"), (2, None)], "id int, t string")
    io.write_jsonl(df, str(tmp_path / "a"))
    io.write_jsonl(df, str(tmp_path / "b"), ascii_only=True)
    for p in ("a", "b"):
        lines = [r.value for r in spark.read.text(str(tmp_path / p)).collect()]
        assert {json.loads(x)["id"]: json.loads(x).get("t") for x in lines} == {1: "ünï 🎛", 2: None}
        assert p == "a" or all(x.isascii() for x in lines)


def test_file_tree(spark, tmp_path):
    for name in ("s1/mix.wav", "s1/a.WAV", "s1/b.flac", "s2/x.wav", "s3/x.wav", "s3/n.mid", "s4/readme.txt"):
        p = tmp_path / name
        p.parent.mkdir(exist_ok=True)
        p.write_bytes(b"0")
    files = io.list_files(spark, str(tmp_path), ("wav", ".FLAC", ".mid"))
    assert files.count() == 6
    songs = {r.dir.rsplit("/", 1)[1]: (r.mix, r.stems, r.midi) for r in io.song_folders(files, 2, mix_file(F.col("names"))).collect()}
    assert songs == {"s1": ("mix.wav", ["a.WAV", "b.flac"], []), "s3": (None, ["x.wav"], ["n.mid"])}
    assert {r.stem for r in io.paired_files(files.where("extension = '.wav'"), files.where("extension = '.mid'")).where("path_a is null").collect()} == {"n"}
    readers = {"files": lambda s, root: io.list_files(s, root)}
    config = [{"name": "a", "kind": "files", "root": str(tmp_path / "s1")}, {"name": "b", "kind": "files", "root": str(tmp_path / "none")}]
    assert io.union_sources(spark, config, readers, strict=False).count() == 3
    with pytest.raises(FileNotFoundError):
        io.union_sources(spark, config, readers, strict=True)
    with pytest.raises(ValueError, match="unknown source kind"):
        io.union_sources(spark, [{"name": "c", "kind": "x", "root": "/"}], readers, strict=False)


def test_manifest_contract(spark):
    df = spark.createDataFrame([(1, "ok", "p"), (2, "error", None)], "id int, status string, path string")
    assert io.prepared_manifest(df.where("id = 1"), ["id", "path"]).count() == 1
    with pytest.raises(Exception, match="missing fields"):
        io.prepared_manifest(df, ["id", "path"]).collect()
    with pytest.raises(ValueError, match="missing fields"):
        io.prepared_manifest(df, ["other"])
    with pytest.raises(ValueError, match="status ok"):
        io.prepared_manifest(df.where("id = 3"), ["id"])


def test_sinks(spark, tmp_path):
    df = spark.createDataFrame([(1, "train"), (2, "val"), (3, "train")], "id int, split string")
    assert {r.split: r.n_rows for r in io.write_splits(df, str(tmp_path / "s")).collect()} == {"train": 2, "val": 1}
    io.write_with_lengths(df, str(tmp_path / "l"), F.length("split"))
    assert {r.lengths for r in spark.read.parquet(str(tmp_path / "l")).collect()} == {5, 3}
    io.write_version(df, str(tmp_path / "v"), 1)
    with pytest.raises(Exception, match="(?i)exists"):
        io.write_version(df, str(tmp_path / "v"), 1)
    for form in ("orc", "csv", "parquet"):
        io.write_sqlike(df, str(tmp_path / form), form)
    assert spark.read.orc(str(tmp_path / "orc")).count() == 3


def test_batches_run_once(spark, tmp_path):
    src, out, cp = (str(tmp_path / n) for n in ("src", "out", "cp"))
    df = spark.createDataFrame([(1, "a"), (2, "b"), (2, "b")], "id int, t string")
    df.coalesce(1).write.parquet(src)
    assert len(inc.append_batches(spark, src, df.schema, out, cp, lambda b: b.withColumn("u", F.upper("t")), "id")) == 1
    assert inc.append_batches(spark, src, df.schema, out, cp, lambda b: b, "id") == []
    spark.createDataFrame([(2, "z"), (3, "c")], "id int, t string").coalesce(1).write.mode("append").parquet(src)
    assert len(inc.append_batches(spark, src, df.schema, out, cp, lambda b: b.withColumn("u", F.upper("t")), "id")) == 1
    assert {(r.id, r.u) for r in inc.merged(spark, out, "id").collect()} == {(1, "A"), (2, "B"), (3, "C")}


def test_watermarked_stream(spark, tmp_path):
    src = str(tmp_path / "ev")
    spark.createDataFrame([(1, "2024-01-01 00:00:10", 1.0), (1, "2024-01-01 00:00:10", 1.0), (2, "2024-01-01 00:07:00", 2.0)], "id long, ts string, value double").withColumn("ts", F.to_timestamp("ts")).write.parquet(src)
    stream = spark.readStream.schema("id long, ts timestamp, value double").parquet(src)
    got = inc.run_to_table(inc.distinct_events(stream, "ts", "id", "1 hour"), str(tmp_path / "o1"), str(tmp_path / "c1"))
    assert got.count() == 2
    tumbled = inc.run_to_table(inc.windowed_counts(stream, "ts", [], "5 minutes", None, "1 minute"), str(tmp_path / "o2"), str(tmp_path / "c2"), "complete")
    assert sorted(r.n for r in tumbled.collect()) == [1, 2]
