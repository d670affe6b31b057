"""Queries of this subpackage, by name, and the SQL they are compared with."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.llm import canonical, linkage, mixture, overlap, spam, tokens, topn


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _texts(spark: SparkSession, folder: str) -> tuple[DataFrame, DataFrame]:
    """Names of Source 1 and addresses of Source 3, as ids and texts."""
    names = table(spark, folder, "train_source1").select(F.col("entity_id").alias("id"), F.col("business_name").alias("text"))
    return names, table(spark, folder, "train_source3").select(F.col("entity_id").alias("id"), F.col("business_address").alias("text"))


def p1_found(spark: SparkSession, folder: str) -> DataFrame:
    names, addresses = map(canonical.lookalike_pairs, _texts(spark, folder))
    return names.unionByName(addresses).select(F.col("a").alias("entity_id_a"), F.col("b").alias("entity_id_b"))


def p1_spellings(spark: SparkSession, folder: str) -> DataFrame:
    names, addresses = map(canonical.spellings, _texts(spark, folder))
    return names.unionByName(addresses)


def _parsed(spark: SparkSession, folder: str, *names: str, **options) -> DataFrame:
    return linkage.parsed({name: table(spark, folder, name) for name in names}, **options)


def _beliefs(spark: SparkSession, folder: str) -> DataFrame:
    sizes = linkage.capacity(table(spark, folder, "train_matches"))
    rows = _parsed(spark, folder, "train_source1", "train_source2", "train_source3", keys=linkage.belief_keys("train_source1"))
    return linkage.belief_matches(rows, "train_source1", ["train_source2", "train_source3"], sizes)


def p2_found(spark: SparkSession, folder: str) -> DataFrame:
    likely = _beliefs(spark, folder).filter("probability >= 0.5")
    return likely.select(F.col("l").alias("source1_entity_id"), F.col("r").alias("matched_entity_id"))


def p2_probabilities(spark: SparkSession, folder: str) -> DataFrame:
    return _beliefs(spark, folder).select(F.col("l").alias("source1_entity_id"), F.col("r").alias("candidate_entity_id"), "probability", "prior")


def p3_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = linkage.same_address(_parsed(spark, folder, "train_source1", "train_source2", names=False), "train_source1", "train_source2")
    return pairs.select(F.col("l").alias("source1_entity_id"), F.col("r").alias("source2_entity_id"))


def p5_found(spark: SparkSession, folder: str) -> DataFrame:
    pairs = linkage.same_name(_parsed(spark, folder, "train_source1", "train_source2", addresses=False), "train_source1", "train_source2")
    return pairs.select(F.col("l").alias("source1_entity_id"), F.col("r").alias("source2_entity_id"))


def p4_found(spark: SparkSession, folder: str) -> DataFrame:
    best = topn.top_n(topn.scored_items(table(spark, folder, "candidate_pairs")), 10)
    return best.select(F.col("grp").alias("source1_entity_id"), F.col("item").alias("candidate_entity_id"))


SPLITS = {"source1": ("train_source1", "test_source1"), "source2": ("train_source2", "test_source2")}


def _overlaps(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.overlaps(_parsed(spark, folder, *(t for pair in SPLITS.values() for t in pair)), SPLITS)


def p6_found(spark: SparkSession, folder: str) -> DataFrame:
    return _overlaps(spark, folder).select(F.col("train_id").alias("train_entity_id"), F.col("eval_id").alias("test_entity_id"))


def p6_counts(spark: SparkSession, folder: str) -> DataFrame:
    return overlap.overlap_counts(_overlaps(spark, folder), SPLITS)


def p7_ids(spark: SparkSession, folder: str) -> DataFrame:
    return tokens.token_ids(table(spark, folder, "documents"))


def p8_mixture(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.mixture(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p8_shares(spark: SparkSession, folder: str) -> DataFrame:
    return mixture.shares(table(spark, folder, "documents"), table(spark, folder, "mix_targets"))


def p9_found(spark: SparkSession, folder: str) -> DataFrame:
    return spam.stuffed_pages(table(spark, folder, "documents"))


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    return {"p1_found": p1_found, "p1_spellings": p1_spellings, "p2_found": p2_found, "p2_probabilities": p2_probabilities, "p3_found": p3_found, "p4_found": p4_found, "p5_found": p5_found, "p6_found": p6_found, "p6_counts": p6_counts, "p7_ids": p7_ids, "p8_mixture": p8_mixture, "p8_shares": p8_shares, "p9_found": p9_found}


def oracle_sql() -> dict[str, str]:
    return {
        "p4_found": """
with x as (
  select source1_entity_id g, trim(unnest(string_split(candidate_entity_ids, ','))) i,
         unnest(list_resize(candidate_scores, greatest(len(candidate_scores), len(string_split(candidate_entity_ids, ','))))) s
  from candidate_pairs where source1_entity_id is not null and candidate_entity_ids is not null and candidate_scores is not null),
m as (select g, i, max(s) s from x where s is not null and (starts_with(i, 'S2-') or starts_with(i, 'S3-')) group by g, i),
r as (select g, i, row_number() over (partition by g order by s desc, i) k from m)
select g as source1_entity_id, i as candidate_entity_id from r where k <= 10""",
    }
