"""The pN_ queries, each over its whole tables, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from corpusloom.llm import broken_pairs, cross_splits, encoding, leakage, near_duplicates, neighbours, packing, splits, subjects

Query = Callable[[SparkSession, str], DataFrame]


def _read(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def _preset_files(spark: SparkSession, d: str) -> DataFrame:
    samples = _read(spark, d, "samples")
    return samples.select(F.col("sample_seq").alias("id"), splits.preset_key(F.col("gt_preset_path")).alias("file"), "split").where("file is not null")


def _told(spark: SparkSession, d: str) -> DataFrame:
    records = _read(spark, d, "sft_records")
    return near_duplicates.record_texts(records.withColumn("side", F.col("split")), "side").withColumnRenamed("side", "split")


def p1_found(spark: SparkSession, d: str) -> DataFrame:
    """(tbl, seq_lo, seq_hi): pairs of rows across train and the other splits that are near-same records or name the same preset file."""
    parts = [("sft_records", cross_splits.cross_split_groups(_told(spark, d), k=3, theta=0.6), "grp"), ("samples", _preset_files(spark, d), "file")]
    found = [cross_splits.cross_pairs(m, key).select(F.lit(t).alias("tbl"), "seq_lo", "seq_hi") for t, m, key in parts]
    return found[0].union(found[1])


def p1_report(spark: SparkSession, d: str) -> DataFrame:
    """(tbl, split, source, n_rows, n_links, n_matches, n_spans, n_words): held-out rows with an overlapping row in train, by split and source.

    The last four come from the index: near texts of train that were aligned with a row (one of each group of the index a text, equal rows
    share those of their class), their maximal matches, and the spans and words of the text that these cover; 0 for samples.
    """
    told = _told(spark, d)
    found = cross_splits.overlaps(told, k=3, theta=0.6)
    rep = found.classes.select("id", "rep").join(told.select("id", "split"), "id")
    trained = rep.where("split = 'train'").select(F.col("rep").alias("a")).distinct()
    spans = found.links.join(trained, "a", "left_semi").groupBy(F.col("b").alias("rep")).agg(*[f.alias(n) for f, n in ((F.count("*"), "n_links"), (F.sum("matches"), "n_matches"), (F.sum("spans"), "n_spans"), (F.sum("words"), "n_words"))])
    counts = rep.join(spans, "rep").select("id", "n_links", "n_matches", "n_spans", "n_words")
    out = []
    for t, members, key, name, seq in (("sft_records", found.groups, "grp", "sft_records", "input_seq"), ("samples", _preset_files(spark, d), "file", "samples", "sample_seq")):
        in_train = members.where("split = 'train'").select(key).distinct()
        hit = members.where("split in ('val', 'test')").join(in_train, key, "left_semi").select("id", "split")
        sources = _read(spark, d, name).select(F.col(seq).alias("id"), "source")
        hit = hit.join(sources, "id").join(counts, "id", "left") if t == "sft_records" else hit.join(sources, "id").withColumns({c: F.lit(0).cast("long") for c in counts.columns[1:]})
        out.append(hit.groupBy(F.lit(t).alias("tbl"), "split", "source").agg(F.count("*").alias("n_rows"), *[F.coalesce(F.sum(c), F.lit(0)).alias(c) for c in counts.columns[1:]]))
    return out[0].union(out[1])


def p2_found(spark: SparkSession, d: str) -> DataFrame:
    """(first_seq, other_seq): of each set of samples that must share a split, the smallest with every other."""
    return splits.sample_sets(_read(spark, d, "samples")).where("node <> root").select(F.col("root").alias("first_seq"), F.col("node").alias("other_seq"))


def p2_assignment(spark: SparkSession, d: str) -> DataFrame:
    """(sample_seq, set_seq, stratum, split): the split of every sample, in the shares of split_plan, also within each archetype."""
    samples = _read(spark, d, "samples")
    plan = [(r.split, r.share) for r in _read(spark, d, "split_plan").collect()]  # one row a split
    done = splits.assign_splits(samples, splits.sample_sets(samples), plan, "sample_seq", "archetype")
    return done.select(F.col("id").alias("sample_seq"), F.col("set").alias("set_seq"), "stratum", "split")


def p3_found(spark: SparkSession, d: str) -> DataFrame:
    """(row_lo, row_hi): pairs of vectors of which one is among the other's five nearest."""
    cache = _read(spark, d, "clap_cache").select(F.col("row_idx").alias("id"), "embedding")
    return neighbours.neighbour_pairs(neighbours.nearest_vectors(cache, k=5, dim=128))


def p4_containers(spark: SparkSession, d: str) -> DataFrame:
    """(budget_id, item_seq, piece, container, size): a container for every row of the budget's table."""
    tables = {
        "file_records": lambda: _read(spark, d, "file_records").select(F.col("file_seq").alias("item"), F.col("tokens").alias("size")),
        "sft_records": lambda: _read(spark, d, "sft_records").select(
            F.col("input_seq").alias("item"), F.aggregate("messages", F.lit(0).cast("long"), lambda s, m: s + F.coalesce(F.length(m["content"]), F.lit(0))).alias("size")
        ),
    }
    budgets = _read(spark, d, "pack_budgets").orderBy("budget_id").collect()  # a fixed table of two rows
    packed = [packing.pack(tables[b.item_table](), b.capacity).select(F.lit(b.budget_id).alias("budget_id"), F.col("item").alias("item_seq"), "piece", "container", "size") for b in budgets]
    return reduce(DataFrame.union, packed)


def p5_groups(spark: SparkSession, d: str) -> DataFrame:
    """(id, grp): every conversation record in a near-duplicate group of two or more."""
    return near_duplicates.near_duplicate_groups(near_duplicates.record_texts(_read(spark, d, "sft_records")), k=3, theta=0.6)


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    """(seq_lo, seq_hi): pairs of records in one near-duplicate group."""
    return near_duplicates.group_pairs(p5_groups(spark, d))


def p6_defects(spark: SparkSession, d: str) -> DataFrame:
    """(tbl, row_seq, defects): every defect of the pairs of both tables."""
    judged = _read(spark, d, "judge_results").select(F.col("judge_seq").alias("id"), "prompt", F.col("reasoning").alias("answer"))
    told = broken_pairs.record_pairs(_read(spark, d, "sft_records"))
    parts = [broken_pairs.broken_pairs(x).select(F.lit(t).alias("tbl"), F.col("id").alias("row_seq"), "defects") for t, x in (("judge_results", judged), ("sft_records", told))]
    return parts[0].union(parts[1])


def p6_found(spark: SparkSession, d: str) -> DataFrame:
    """(tbl, row_seq, defect): the first defect of each defective pair."""
    return p6_defects(spark, d).select("tbl", "row_seq", F.col("defects")[0].alias("defect"))


def p7_ids(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, ids): the token ids of every document."""
    return encoding.encode_corpus(_read(spark, d, "documents"))


def p8_found(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, item_id): documents that hold at least 12 consecutive words of an evaluation text."""
    docs, items = _read(spark, d, "documents"), _read(spark, d, "eval_items")
    found = leakage.leaked_passages(docs.select(F.col("doc_id").alias("id"), "text"), items.select(F.col("item_id").alias("id"), "text"), least=12, k=8)
    return found.select(F.col("doc").alias("doc_id"), F.col("item").alias("item_id"))


def p9_found(spark: SparkSession, d: str) -> DataFrame:
    """(doc_id, subject): the subjects that at least a quarter of the document's sentences are about."""
    names = sorted(r.subject for r in _read(spark, d, "subjects").select("subject").collect())  # a fixed table of eight rows
    docs = _read(spark, d, "documents").select(F.col("doc_id").alias("id"), "text")
    found = subjects.document_subjects(docs, _read(spark, d, "doc_labels").select(F.col("doc_id").alias("id"), "subject"), names)
    return found.select(F.col("id").alias("doc_id"), "subject")


def queries() -> dict[str, Query]:
    return {
        "p1_found": p1_found, "p1_report": p1_report, "p2_found": p2_found, "p2_assignment": p2_assignment, "p3_found": p3_found, "p4_containers": p4_containers, "p5_found": p5_found, "p5_groups": p5_groups,
        "p6_found": p6_found, "p6_defects": p6_defects, "p7_ids": p7_ids, "p8_found": p8_found, "p9_found": p9_found,
    }


_WORDS = r"'[\p{L}\p{N}]+'"
_GROUPS = (
    "with recursive t as (select input_seq as id, regexp_extract_all(lower(array_to_string(list_transform(list_filter(messages, lambda m: m.role in ('user', 'assistant') and m.content is not null), lambda m: m.content), chr(10))), " + _WORDS + ") as w from sft_records), "
    "s as (select distinct id, w[i] || ' ' || w[i + 1] || ' ' || w[i + 2] as g from (select id, w, unnest(range(1, len(w) - 1)) as i from t)), n as (select id, count(*) as n from s group by 1), "
    "p as (select a.id as a, b.id as b, count(*) as c from s a join s b on a.g = b.g and a.id < b.id group by 1, 2), e as (select p.a, p.b from p join n x on x.id = p.a join n y on y.id = p.b where c * 10 >= 6 * (x.n + y.n - c)), "
    "adj as (select a, b from e union select b, a from e), r as (select a as id, a as root from adj union select adj.b, r.root from r join adj on adj.a = r.id), g as (select id, min(root) as grp from r group by 1) "
)


def oracle_sql() -> dict[str, str]:
    """P5 and P8 by brute force; the others' results SQL does not give (approximate, packed, learned, by a vocabulary) or not in bounded time."""
    return {
        "p5_groups": _GROUPS + "select id, grp from g",
        "p5_found": _GROUPS + "select x.id as seq_lo, y.id as seq_hi from g x join g y on x.grp = y.grp and x.id < y.id",
        "p8_found": "with d as (select doc_id, regexp_extract_all(lower(text), " + _WORDS + ") as w from documents), i as (select item_id, regexp_extract_all(lower(text), " + _WORDS + ") as w from eval_items), "
        "dg as (select doc_id, array_to_string(w[k:k + 11], ' ') as g from (select doc_id, w, unnest(range(1, len(w) - 10)) as k from d)), ig as (select distinct item_id, array_to_string(w[k:k + 11], ' ') as g from (select item_id, w, unnest(range(1, len(w) - 10)) as k from i)) "
        "select distinct doc_id, item_id from dg join ig using (g)",
    }
