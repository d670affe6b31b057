"""Readers of record tables and writers of result lists."""

from __future__ import annotations

import json
import os

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions import vocabulary as V
from tallyweave.functions.text import clean, join_id_list, parse_id_list

RECORD = "entity_id string, business_name string, business_address string, country string"
TRUTH = "source1_entity_id string, matched_entity_ids string"
EXPECTED_FILES = tuple(f"{p}_source{k}.tsv" for p in ("train", "test") for k in (1, 2, 3)) + ("train_ground_truth.tsv",)


def exists(spark: SparkSession, path: str) -> bool:
    jvm = spark.sparkContext._jvm
    target = jvm.org.apache.hadoop.fs.Path(path)
    return target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(target)


def _tsv(spark: SparkSession, path: str, schema: str) -> DataFrame:
    if not exists(spark, path):
        raise FileNotFoundError(path)
    read = spark.read.schema(schema).option("sep", "\t").option("header", True).option("quote", '"').option("escape", '"').option("multiLine", True)
    return read.option("emptyValue", "").option("nullValue", "\u0000").option("encoding", "UTF-8").csv(path)


def load_source_tsv(spark: SparkSession, path: str) -> DataFrame:
    """Records of one source as text: nothing is inferred, blanks at the ends go, missing is ''."""
    df = _tsv(spark, path, RECORD)
    return df.select(*(clean(F.col(c)).alias(c) for c in df.columns))


def load_source_parquet(spark: SparkSession, path: str) -> DataFrame:
    """As :func:`load_source_tsv` from a table; other columns are left out, repeated rows are one."""
    names = RECORD.replace(" string", "").split(", ")
    return spark.read.parquet(path).select(*(clean(F.col(c).cast("string")).alias(c) for c in names)).distinct()


def require_unique_ids(records: DataFrame, key: str = "entity_id") -> DataFrame:
    """``records``, or an error that names some ids met in more than one of its rows; null ids count as one id."""
    repeated = [r[0] for r in records.groupBy(key).count().filter("count > 1").orderBy(key).select(key).limit(5).collect()]
    if repeated:
        raise ValueError(f"{key} is not unique, for example {', '.join(map(str, repeated))}")
    return records


def load_ground_truth(spark: SparkSession, path: str) -> DataFrame:
    """Matches of each Source 1 record, as text and as the array ``targets``."""
    df = _tsv(spark, path, TRUTH)
    df = df.select(*(clean(F.col(c)).alias(c) for c in df.columns))
    return df.withColumn("targets", parse_id_list(F.col("matched_entity_ids")))


def load_all_sources(spark: SparkSession, folder: str, prefix: str) -> tuple[DataFrame, DataFrame, DataFrame]:
    return tuple(load_source_tsv(spark, f"{folder}/{prefix}_source{k}.tsv") for k in (1, 2, 3))


def read_ids(spark: SparkSession, path: str) -> DataFrame:
    """Distinct ids in the first column of a text file with a header; blank lines are left out."""
    lines = _lines(spark, path).filter("line > 1")
    return lines.select(F.trim(F.split_part("value", F.lit("\t"), F.lit(1))).alias("id")).filter("id <> ''").distinct()


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """``(line, value)`` of a text file; line numbers follow the order of the file."""
    numbered = spark.read.text(path).select("value", F.monotonically_increasing_id().alias("at"), F.spark_partition_id().alias("part"))
    counts = numbered.groupBy("part").agg(F.count("*").alias("n"), F.min("at").alias("first"))
    before = counts.alias("a").join(counts.alias("b"), F.col("b.part") < F.col("a.part"), "left")
    offsets = before.groupBy(F.col("a.part").alias("part"), F.col("a.first").alias("first")).agg(F.coalesce(F.sum("b.n"), F.lit(0)).alias("before"))
    return numbered.join(offsets, "part").select((F.col("at") - F.col("first") + F.col("before") + 1).alias("line"), "value")


def load_match_targets(spark: SparkSession, folder: str, prefix: str = "test") -> tuple[DataFrame | None, list[str]]:
    """Ids of Sources 2 and 3, or None with a warning where a file is absent."""
    paths = [f"{folder}/{prefix}_source{k}.tsv" for k in (2, 3)]
    warnings = [f"{os.path.basename(p)} is absent: ids can't be checked" for p in paths if not exists(spark, p)]
    if warnings:
        return None, warnings
    return read_ids(spark, paths[0]).union(read_ids(spark, paths[1])).distinct(), []


def id_lists(pairs: DataFrame, left: DataFrame, name: str) -> DataFrame:
    """``(source1_entity_id, <name>)``: a sorted comma list for every row of ``left``, '' where it has no pair.

    ``pairs`` has ``s1_id`` and ``cand_id``; repeated pairs count once.
    """
    lists = pairs.groupBy("s1_id").agg(F.collect_set("cand_id").alias("ids"))
    ids = left.select(F.col("entity_id").alias("s1_id")).distinct()
    return ids.join(lists, "s1_id", "left").select(F.col("s1_id").alias("source1_entity_id"), F.coalesce(join_id_list(F.col("ids")), F.lit("")).alias(name))


def export_id_lists(lists: DataFrame, path: str) -> None:
    """Write id lists, ordered by id, as one tab-separated text file with a header line and a newline at the end.

    Executors write the parts into the shared file system; the file is put together
    there from the header and the parts in order, without a row passing the driver.
    """
    spark, (ids, name) = lists.sparkSession, lists.columns
    parts = path + ".parts"
    lists.orderBy(ids).select(F.concat_ws("\t", F.col(ids), F.col(name)).alias("value")).write.mode("overwrite").text(parts)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    at = jvm.org.apache.hadoop.fs.Path
    system = at(path).getFileSystem(conf)
    out = system.create(at(path), True)
    try:
        out.write(bytearray(f"{ids}\t{name}\n".encode()))
        for name_ in sorted(f.getPath().getName() for f in system.listStatus(at(parts)) if f.getPath().getName().startswith("part-")):
            part = system.open(at(f"{parts}/{name_}"))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(part, out, conf, False)
            finally:
                part.close()
    finally:
        out.close()
    system.delete(at(parts), True)


def export_variants(path: str) -> None:
    """Write the table of spelling variants as JSON."""
    with open(path, "w", encoding="utf-8") as out:
        json.dump({f"{a}|{b}": w for a, b, w in V.VARIANTS}, out, indent=2)


def missing_files(spark: SparkSession, folder: str) -> list[str]:
    return [name for name in EXPECTED_FILES if not exists(spark, f"{folder}/{name}")]


def preview(lists: DataFrame, n: int = 10) -> tuple[DataFrame, DataFrame]:
    """Counts of records with and without matches, and the first rows."""
    name = lists.columns[1]
    counts = lists.agg(F.count_if(F.col(name) != "").alias("matched"), F.count_if(F.col(name) == "").alias("single"))
    return counts, lists.orderBy(lists.columns[0]).limit(n)
