"""The whole linkage: load, normalize, block, learn, decide, export."""

from __future__ import annotations

import argparse
import gc
import time
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.functions.text import normalized, text_for_retrieval
from tallyweave.operators import blocking, decide, features, idf, retrieval
from tallyweave.operators.countries import with_country_keys
from tallyweave.operators.model import PairEnsemble
from tallyweave.plans.durable import cut
from tallyweave.sources import records as io


#: Pairs that are scored at a time, about, and those of one task.
ROUND, TASK = 4_000_000, 100_000


@dataclass
class Options:
    sample_train: int = 150_000  # labelled records used for training; 0 for all
    negatives: float = 10.0
    top_k: int = 20
    per_key: int | None = None  # rule candidates of a record by one key, and in all; None for all
    per_record: int | None = None
    trees: int = 40
    depth: int = 5
    add_true: bool = True


def elapsed(since: float) -> str:
    seconds = int(time.time() - since)
    return f"{seconds // 60}m {seconds % 60:02d}s"


def candidates(left: DataFrame, right: DataFrame, k: int = 20, asked: DataFrame | None = None, per_key: int | None = blocking.PER_KEY, per_record: int | None = blocking.PER_RECORD) -> DataFrame:
    """Rule candidates, see :func:`blocking.rule_candidates`, and retrieved candidates of normalized records with their ``country_key``.

    With ``asked (entity_id)`` those of these left records only, as they are among all of ``left``.
    """
    return blocking.listed_pairs(*listed(left, right, k, asked, per_key, per_record))


def listed(left: DataFrame, right: DataFrame, k: int, asked: DataFrame | None, per_key: int | None, per_record: int | None) -> tuple[DataFrame, blocking.Codes]:
    """:func:`candidates` as lists of codes, see :func:`blocking.rule_codes`."""
    retrieved = retrieval.tfidf_candidates(left, right, text_for_retrieval(F.col("name_norm"), F.col("address_norm")), k, asked=asked)
    mine = left if asked is None else left.join(asked, "entity_id", "left_semi")
    return blocking.rule_codes(mine, right, per_key, per_record, more=retrieved.select("s1_id", "cand_id"))


def scored_above(lists: DataFrame, codes: blocking.Codes, left: DataFrame, right: DataFrame, weights: idf.WordWeights, ensemble: PairEnsemble, threshold: float) -> DataFrame:
    """``(s1_id, cand_id, proba)`` of the pairs of ``lists`` at or above ``threshold``.

    All pairs are scored, in rounds of left records with about :data:`ROUND` of them together: only those of a
    round, with all they bring to the features, are on disk at once. A record's pairs are in one round, whose features compare them.
    """
    spark = lists.sparkSession
    total = lists.agg(F.sum(F.size("codes").cast("bigint"))).first()[0] or 0
    rounds = max(1, -(-total // ROUND))
    parts = max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-min(total, ROUND) // TASK))
    if rounds > 1:
        left, right = (cut(features.described(d, weights), "described") for d in (left, right))
        lists = cut(lists.withColumn("round", F.pmod(F.xxhash64("s1_id"), F.lit(rounds)).cast("int")).repartition("round"), "rounds", ["round"])
    else:
        left, right = (features.described(d, weights) for d in (left, right))
    kept = []
    for k in range(rounds):
        pairs = blocking.listed_pairs(lists.filter(F.col("round") == k) if rounds > 1 else lists, codes)
        scored = ensemble.score(features.features_of(pairs.repartition(parts, "s1_id"), left, right, parts)).filter(F.col("proba") >= threshold)
        kept.append(cut(scored.select("s1_id", "cand_id", "proba"), "scored"))
        # What a round shuffled is removed once nothing names it any more.
        del pairs, scored
        gc.collect()
        spark.sparkContext._jvm.System.gc()
    return reduce(DataFrame.unionByName, kept)


def learn(pairs: DataFrame, truth: DataFrame, left: DataFrame, right: DataFrame, weights: idf.WordWeights, options: Options) -> tuple[PairEnsemble, DataFrame]:
    """The trained ensemble and its scored validation pairs, with labels."""
    rows = decide.validation_split(decide.training_pairs(pairs, truth, options.negatives, add_true=options.add_true))
    matrix = cut(features.feature_matrix(rows, left, right, weights), "training")
    ensemble = PairEnsemble(trees=options.trees, depth=options.depth).fit(matrix)
    return ensemble, ensemble.score(matrix.filter("is_val"))


def link(left: DataFrame, right: DataFrame, truth: DataFrame, options: Options | None = None, test: tuple[DataFrame, DataFrame] | None = None) -> tuple[DataFrame, DataFrame, float]:
    """``(matches, candidates, threshold)`` of raw records; ``truth (s1_id, targets)`` labels some of ``left``.

    Matches are made for ``test`` records, or for ``left`` and ``right`` without. Unless ``options`` cap them,
    all pairs that share a key are candidates.
    """
    options = options or Options()
    every = with_country_keys(*(cut(normalized(d), "normalized") for d in (left, right, *(test or ()))))
    left, right, test_left, test_right = every if test else every * 2
    texts = left.select("name_norm").union(right.select("name_norm"))
    if test:
        texts = texts.union(test_left.select("name_norm")).union(test_right.select("name_norm"))
    weights = idf.fit(texts, "name_norm")
    weights.table = cut(weights.table, "idf")

    labelled = truth if not options.sample_train else decide.sample_records(truth, options.sample_train, key="s1_id")
    labelled = cut(labelled, "labelled")
    mine = left.join(labelled.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_semi")
    caps = {"per_key": options.per_key, "per_record": options.per_record}
    pairs = cut(candidates(mine, right, options.top_k, **caps), "pairs")
    ensemble, validation = learn(pairs, labelled, left, right, weights, options)
    val_truth = decide.validation_split(labelled).filter("is_val")
    best = decide.best_threshold(validation, val_truth, "proba").first()
    threshold = best.threshold if best and best.macro_f05 > 0 else decide.NO_THRESHOLD

    lists, codes = listed(test_left, test_right, options.top_k, None, **caps)
    lists = cut(lists, "lists")
    scored = scored_above(lists, codes, test_left, test_right, weights, ensemble, threshold)
    return decide.assign(scored, threshold, "proba").select("s1_id", "cand_id", "proba"), blocking.listed_pairs(lists, codes), threshold


def run(spark: SparkSession, data: str, output: str, options: Options | None = None) -> float:
    """Run on the tab-separated tables in ``data`` and write the two result files to ``output``; the threshold."""
    started = time.time()
    s1, s2, s3 = map(io.require_unique_ids, io.load_all_sources(spark, data, "train"))
    t1, t2, t3 = map(io.require_unique_ids, io.load_all_sources(spark, data, "test"))
    truth = io.load_ground_truth(spark, f"{data}/train_ground_truth.tsv").select(F.col("source1_entity_id").alias("s1_id"), "targets")
    matches, found, threshold = link(s1, s2.unionByName(s3), truth, options, (t1, t2.unionByName(t3)))
    io.export_id_lists(io.id_lists(found, t1, "candidate_entity_ids"), f"{output}/candidate_pairs.tsv")
    io.export_id_lists(io.id_lists(matches, t1, "matched_entity_ids"), f"{output}/matching_results.tsv")
    print(f"done in {elapsed(started)}; threshold {threshold:.2f}")
    return threshold


def main(arguments: list[str] | None = None) -> None:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("--data-dir", required=True)
    p.add_argument("--output-dir", required=True)
    p.add_argument("--sample-train", type=int, default=150_000)
    p.add_argument("--neg-ratio", type=float, default=10.0)
    p.add_argument("--no-gpu", action="store_true", help="accepted for compatibility; nothing here uses a GPU")
    a = p.parse_args(arguments)
    spark = SparkSession.builder.appName("tallyweave").getOrCreate()
    run(spark, a.data_dir, a.output_dir, Options(sample_train=a.sample_train, negatives=a.neg_ratio, per_key=blocking.PER_KEY, per_record=blocking.PER_RECORD))


if __name__ == "__main__":
    main()
