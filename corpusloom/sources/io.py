"""Readers and writers (S1 to S13, K1 to K7).  Every reader takes a schema; none infers one from the data."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

MIDI = (".mid", ".midi")
AUDIO = (".wav", ".flac", ".mp3", ".ogg")


def read_jsonl(spark: SparkSession, paths: str | list[str], schema: str, on_bad: str = "raise", recursive: bool = False) -> DataFrame:
    """JSON lines with ``src_file``; blank lines are skipped.

    on_bad: ``raise`` fails at the first broken line, ``skip`` leaves broken lines out, ``keep`` returns them in ``_corrupt_record``.
    """
    fields = T._parse_datatype_string(schema)
    reader = spark.read.option("recursiveFileLookup", str(recursive).lower())
    if on_bad == "raise":
        return reader.schema(fields).option("mode", "FAILFAST").json(paths).withColumn("src_file", F.col("_metadata.file_name"))
    full = T.StructType([*fields.fields, T.StructField("_corrupt_record", T.StringType())])
    df = reader.schema(full).option("mode", "PERMISSIVE").json(paths).withColumn("src_file", F.col("_metadata.file_name"))
    if on_bad == "keep":
        return df
    return df.where("_corrupt_record is null").drop("_corrupt_record")


def with_line_numbers(spark: SparkSession, paths: str | list[str]) -> DataFrame:
    """(src_file, seq, value): the lines of text files in file order; each file is read whole, so this suits manifests, not corpora."""
    t = spark.read.text(paths, wholetext=True).select(F.col("_metadata.file_path").alias("src_file"), "value")
    return t.select("src_file", F.posexplode(F.split("value", "\n")).alias("seq", "value")).where(F.trim("value") != "")


def list_files(spark: SparkSession, root: str, extensions: tuple[str, ...] | None = None) -> DataFrame:
    """(path, dir, name, extension, size) of all files below a folder, without reading them; extensions are compared in lower case with a leading dot."""
    f = spark.read.format("binaryFile").option("recursiveFileLookup", "true").load(root).select("path", F.col("length").alias("size"))
    f = f.select("path", F.regexp_extract("path", r"^(.*)/[^/]*$", 1).alias("dir"), F.regexp_extract("path", r"([^/]*)$", 1).alias("name"), "size")
    f = f.withColumn("extension", F.lower(F.regexp_extract("name", r"(\.[^.]*)$", 1)))
    wanted = [e.lower() if e.startswith(".") else "." + e.lower() for e in extensions or ()]
    return f.where(F.col("extension").isin(wanted)) if wanted else f


def song_folders(files: DataFrame, min_stems: int, mix: Column) -> DataFrame:
    """One row a folder with its mix, stems and MIDI files; a folder under ``min_stems`` stays if it has MIDI.  ``mix`` picks a name from the column ``names``."""
    g = files.groupBy("dir").agg(F.array_sort(F.collect_list(F.when(F.col("extension").isin(*AUDIO), F.col("name")))).alias("names"), F.array_sort(F.collect_list(F.when(F.col("extension").isin(*MIDI), F.col("name")))).alias("midi"))
    g = g.withColumn("mix", mix).withColumn("stems", F.filter("names", lambda n: F.coalesce(n != F.col("mix"), F.lit(True))))
    return g.where((F.size("stems") >= min_stems) | (F.size("midi") > 0)).drop("names")


def union_sources(spark: SparkSession, config: list[dict], readers: dict, strict: bool) -> DataFrame:
    """The sources of a configuration, united by name; an unknown kind raises, a missing root raises if strict, else is left out."""
    out = None
    for entry in config:
        if entry["kind"] not in readers:
            raise ValueError(f"unknown source kind {entry['kind']}")
        root = spark._jvm.org.apache.hadoop.fs.Path(entry["root"])
        if not root.getFileSystem(spark._jsc.hadoopConfiguration()).exists(root):
            if strict:
                raise FileNotFoundError(entry["root"])
            continue
        df = readers[entry["kind"]](spark, entry["root"]).withColumn("source", F.lit(entry["name"]))
        out = df if out is None else out.unionByName(df, allowMissingColumns=True)
    if out is None:
        raise ValueError("no source has a root")
    return out


def paired_files(a: DataFrame, b: DataFrame) -> DataFrame:
    """Two listings joined on the file stem; of equal stems the last path wins; a side without partner has null."""
    last = lambda f, n: f.groupBy(F.regexp_replace("name", r"\.[^.]*$", "").alias("stem")).agg(F.max("path").alias(n))
    return last(a, "path_a").join(last(b, "path_b"), "stem", "full_outer")


def indexed_rows(vectors: DataFrame, meta: DataFrame, key: str) -> DataFrame:
    """Vectors with their metadata; raises unless both have the same number of rows."""
    n, m = vectors.count(), meta.count()
    if n != m:
        raise ValueError(f"{n} vectors, {m} rows of metadata")
    return vectors.join(meta, key)


def prepared_manifest(df: DataFrame, required: list[str]) -> DataFrame:
    """Rows of status ``ok``; a null or missing required field raises at the first action; no ok row raises."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"missing fields: {missing}")
    bad = F.filter(F.array(*[F.when(F.col(c).isNull(), F.lit(c)) for c in required]), lambda c: c.isNotNull())
    checked = df.where(F.when(F.size(bad) > 0, F.raise_error(F.concat(F.lit("missing fields: "), F.array_join(bad, ", ")))).otherwise(F.lit(True)))
    ok = checked.where("status = 'ok'")
    if ok.isEmpty():
        raise ValueError("no row has status ok")
    return ok


def write_jsonl(df: DataFrame, path: str, ascii_only: bool = False) -> None:
    """K1: JSON lines; ascii_only escapes every other character."""
    line = F.to_json(F.struct(*df.columns))
    if ascii_only:
        line = F.array_join(F.transform(F.split(line, ""), lambda c: F.when((F.length(c) > 0) & ~c.rlike(r"^[\x00-\x7F]$"), F.concat(F.lit("\\u"), F.lower(F.substring(F.hex(F.encode(c, "UTF-16BE")), 1, 4)), F.when(F.length(F.hex(F.encode(c, "UTF-16BE"))) > 4, F.concat(F.lit("\\u"), F.lower(F.substring(F.hex(F.encode(c, "UTF-16BE")), 5, 4)))).otherwise(F.lit("")))).otherwise(c)), "")
    df.select(line.alias("value")).write.mode("errorifexists").text(path)


def write_splits(df: DataFrame, path: str, split: str = "split") -> DataFrame:
    """K4, K7: rows partitioned by split, and the written counts by split as the summary."""
    df.write.mode("errorifexists").partitionBy(split).parquet(path)
    return df.sparkSession.read.parquet(path).groupBy(split).agg(F.count("*").alias("n_rows"))


def write_with_lengths(df: DataFrame, path: str, length: Column) -> None:
    """K5: the rows with a ``lengths`` column."""
    df.withColumn("lengths", length).write.mode("errorifexists").parquet(path)


def write_version(df: DataFrame, base: str, version: int) -> str:
    """K6: a new version beside the old ones; an input is never overwritten."""
    path = f"{base}/v={version}"
    df.write.mode("errorifexists").parquet(path)
    return path


def write_sqlike(df: DataFrame, path: str, form: str) -> None:
    """Parquet, ORC or CSV with a header."""
    w = df.write.mode("errorifexists")
    w.option("header", "true").csv(path) if form == "csv" else w.format(form).save(path)
