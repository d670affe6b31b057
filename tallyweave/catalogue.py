"""Queries of the core library, by name, and the SQL they are compared with.

Records of ``train_source1`` are the left side, those of ``train_source2`` and
``train_source3`` the right; ``train_matches`` labels a sample of the left, and
``candidate_pairs`` holds scored candidates and, with its dirt, result lines to
be validated. Every query runs over its whole tables.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave import oracle
from tallyweave.functions import similarity as S
from tallyweave.functions import text as T
from tallyweave.operators import blocking, cluster, decide, features, idf, model, quality, retrieval, validate, variants
from tallyweave.operators.countries import with_country_keys
from tallyweave.plans import pipeline
from tallyweave.plans.durable import cut, mark
from tallyweave.sources.records import id_lists, load_source_parquet

RIGHT = ("train_source2", "train_source3")


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def left_records(spark, folder) -> DataFrame:
    return load_source_parquet(spark, f"{folder}/train_source1.parquet")


def right_records(spark, folder) -> DataFrame:
    one, two = (load_source_parquet(spark, f"{folder}/{t}.parquet") for t in RIGHT)
    return one.unionByName(two)


def _both(spark, folder) -> list[DataFrame]:
    return with_country_keys(cut(T.normalized(left_records(spark, folder)), "left"), cut(T.normalized(right_records(spark, folder)), "right"))


def _keyed(spark, folder) -> list[DataFrame]:
    """Both sides with the columns of their blocking keys only."""
    sides = (left_records(spark, folder), right_records(spark, folder))
    return with_country_keys(*(cut(T.normalized(d).select(*blocking.KEY_COLUMNS), "keyed") for d in sides))


def _worded(spark, folder) -> list[DataFrame]:
    """Both sides with the columns of their retrieval text and blocking keys only."""
    sides = (left_records(spark, folder), right_records(spark, folder))
    columns = dict.fromkeys((*blocking.KEY_COLUMNS, "name_norm", "address_norm"))
    return with_country_keys(*(cut(T.normalized(d).select(*columns), "worded") for d in sides))


def _all(spark, folder) -> DataFrame:
    return T.normalized(left_records(spark, folder).unionByName(right_records(spark, folder)))


def truth(spark, folder) -> DataFrame:
    rows = table(spark, folder, "train_matches")
    return rows.select(F.col("source1_entity_id").alias("s1_id"), T.parse_id_list(F.col("matched_entity_ids")).alias("targets"))


def _pair_rows(spark, folder) -> DataFrame:
    """Pairs of Source 1 records and Source 2 or 3 ids with their scores, as often as they are listed."""
    rows = table(spark, folder, "candidate_pairs").select(F.col("source1_entity_id").alias("s1_id"), F.explode(F.arrays_zip(F.split("candidate_entity_ids", ",").alias("i"), F.col("candidate_scores").alias("s"))).alias("x"))
    return rows.select("s1_id", F.trim("x.i").alias("cand_id"), F.col("x.s").alias("score")).filter("score is not null").filter(F.col("cand_id").rlike("^S[23]-"))


def scored_pairs(spark, folder) -> DataFrame:
    """Distinct pairs of Source 1 records and Source 2 or 3 ids with their highest score."""
    rows = _pair_rows(spark, folder)
    return rows.groupBy("s1_id", "cand_id").agg(F.max("score").alias("score"))


def attributed_pairs(spark, folder) -> DataFrame:
    left, right = map(features.with_sets, _both(spark, folder))
    return features.with_attributes(scored_pairs(spark, folder).select("s1_id", "cand_id"), left, right, (*features.ATTRIBUTES, *features.SETS))


def _rounded(columns: dict) -> list:
    return [F.round(c, 6).alias(n) for n, c in columns.items()]


# ---------------------------------------------------------------- normalization


def normalize_names(spark, folder):
    return _all(spark, folder).select("entity_id", "has_name", "name_norm", "name_sorted", "legal_suffix", "name_core", "core_sorted", "name_len", "name_ntoken")


def normalize_addresses(spark, folder):
    return _all(spark, folder).select("entity_id", "has_address", "address_norm", "pincode", "has_pincode", "street_num", "has_landmark", "addr_token1", "country_norm")


def normalize_addresses_indian(spark, folder):
    rows = T.normalized(left_records(spark, folder).unionByName(right_records(spark, folder)), indian=True)
    return rows.select("entity_id", "address_norm")


def retrieval_text(spark, folder):
    return _all(spark, folder).select("entity_id", T.text_for_retrieval(F.col("name_norm"), F.col("address_norm")).alias("text_rep"))


def parsed_truth(spark, folder):
    rows = truth(spark, folder)
    return rows.select("s1_id", F.size("targets").alias("n_targets"), T.join_id_list(F.col("targets")).alias("targets"))


# ---------------------------------------------------------------- blocking


def _block(kind: str):
    def query(spark, folder):
        left, right = _both(spark, folder)
        return blocking.capped_candidates(left, right, (kind,)).select("s1_id", "cand_id", "key")

    return query


def block_union_capped(spark, folder):
    return blocking.rule_candidates(*_keyed(spark, folder))


def candidate_lists(spark, folder):
    lists = blocking.rule_lists(*_keyed(spark, folder))
    return lists.select(F.col("s1_id").alias("source1_entity_id"), T.join_id_list(F.col("ids")).alias("candidate_entity_ids"))


def _text():
    return T.text_for_retrieval(F.col("name_norm"), F.col("address_norm"))


def _texts(spark, folder) -> list[DataFrame]:
    """Both sides with the columns of their retrieval text only."""
    sides = (left_records(spark, folder), right_records(spark, folder))
    return with_country_keys(*(cut(T.normalized(d).select("entity_id", "country_norm", "name_norm", "address_norm"), "texts") for d in sides))


def _retrieve(find: Callable, spark, folder):
    out = find(*_texts(spark, folder), _text())
    return out.select("s1_id", "cand_id", F.round("score", 6).alias("score"), F.col("rank").cast("long").alias("rank"))


def tfidf_top20(spark, folder):
    return _retrieve(retrieval.tfidf_candidates, spark, folder)


def bm25_top20(spark, folder):
    return _retrieve(retrieval.bm25_candidates, spark, folder)


def minhash_candidates(spark, folder):
    return blocking.minhash_candidates(*_both(spark, folder))


def block_sound(spark, folder):
    return blocking.keyed_candidates(*_both(spark, folder), blocking.sound_key(F.col("name_core")))


def block_place(spark, folder):
    return blocking.keyed_candidates(*_both(spark, folder), blocking.place_key(F.col("address_norm")))


def tfidf_cosine_pairs(spark, folder):
    since = mark()
    rows = retrieval.pair_cosines(_pair_rows(spark, folder), *_texts(spark, folder), _text(), since)
    return rows.select("s1_id", "cand_id", F.round("cosine", 6).alias("cosine"))


def record_flags(spark, folder):
    return quality.record_flags(_all(spark, folder))


def raw_suffix_pairs(spark, folder):
    return attributed_pairs(spark, folder).select("s1_id", "cand_id", quality.raw_suffix_agreement(F.col("name_norm_1"), F.col("name_norm_2")).alias("raw_suffix_agreement"))


def landmark_pairs(spark, folder):
    return attributed_pairs(spark, folder).select("s1_id", "cand_id", F.round(quality.landmark_overlap(F.col("address_norm_1"), F.col("address_norm_2")), 6).alias("landmark_overlap"))


def hybrid_candidates(spark, folder):
    """Rule candidates and the twenty best of each record by weighted terms."""
    return pipeline.candidates(*_worded(spark, folder))


def _recall(pairs, spark, folder):
    out = blocking.blocking_recall(pairs, truth(spark, folder))
    return out.select(*_rounded({"recall": F.col("recall"), "avg_candidates": F.col("avg_candidates")}), "captured", "total_true")


def blocking_recall(spark, folder):
    # A record's candidates don't depend on other left records, and recall counts those of labelled ones.
    left, right = _keyed(spark, folder)
    return _recall(cut(blocking.rule_candidates(left.join(_labelled(spark, folder), "entity_id", "left_semi"), right, few=True), "pairs"), spark, folder)


def _labelled(spark, folder) -> DataFrame:
    return truth(spark, folder).select(F.col("s1_id").alias("entity_id")).distinct()


def hybrid_recall(spark, folder):
    # As in blocking_recall; weights of terms are still those of all records.
    return _recall(cut(pipeline.candidates(*_worded(spark, folder), asked=_labelled(spark, folder)), "hybrid"), spark, folder)


def reduction_ratio(spark, folder):
    left, right = _keyed(spark, folder)
    out = blocking.reduction_of(blocking.rule_pairs(left, right), left, right)
    return out.select("pairs", F.round("reduction_ratio", 8).alias("reduction_ratio"))


def fn_mining(spark, folder):
    left, right = _both(spark, folder)
    return blocking.missed_patterns(scored_pairs(spark, folder), truth(spark, folder), left, right)


# ---------------------------------------------------------------- features


TEST = ("test_source1", "test_source2")


def _names(spark, folder) -> DataFrame:
    """Normalized names of all records, of training and test: word weights are those of both."""
    rows = left_records(spark, folder).unionByName(right_records(spark, folder))
    for name in TEST:
        rows = rows.unionByName(load_source_parquet(spark, f"{folder}/{name}.parquet"))
    return T.normalized(rows).select("name_norm")


def _weights(spark, folder) -> idf.WordWeights:
    weights = idf.fit(cut(_names(spark, folder), "names"), "name_norm")
    weights.table = cut(weights.table, "idf")
    return weights


def idf_table(spark, folder):
    return idf.idf_table(_names(spark, folder), "name_norm").select("token", "df", F.round("idf", 6).alias("idf"))


def weighted_pairs(spark, folder, *more: str) -> DataFrame:
    """Pairs with the weighted words of both records, and further attributes."""
    weights = _weights(spark, folder)
    left, right = (weights.attach(d, features.WEIGHTED) for d in _both(spark, folder))
    if more:
        left, right = features.with_sets(left), features.with_sets(right)
    return features.with_attributes(scored_pairs(spark, folder).select("s1_id", "cand_id"), left, right, (*(f"{c}_weights" for c in features.WEIGHTED), *more))


def weighted_jaccard_pairs(spark, folder):
    return weighted_pairs(spark, folder).select("s1_id", "cand_id", *_rounded(features.weighted_similarities()))


def token_jaccard_pairs(spark, folder):
    kinds = {k: v for k, v in features.set_similarities().items() if k.endswith("_set")}
    return attributed_pairs(spark, folder).select("s1_id", "cand_id", *_rounded(kinds))


def char3_jaccard_pairs(spark, folder):
    kinds = {k: v for k, v in features.set_similarities().items() if k.endswith("char3")}
    return attributed_pairs(spark, folder).select("s1_id", "cand_id", *_rounded(kinds))


def len_ratios(spark, folder):
    kinds = {k: v for k, v in features.set_similarities().items() if k.endswith("ratio")}
    return attributed_pairs(spark, folder).select("s1_id", "cand_id", *_rounded(kinds))


def structured_pair_features(spark, folder):
    return attributed_pairs(spark, folder).select("s1_id", "cand_id", *(c.alias(n) for n, c in features.structured().items()))


def interaction_flags(spark, folder):
    rows = weighted_pairs(spark, folder, *features.ATTRIBUTES, *features.SETS)
    rows = rows.withColumns({**features.structured(), **features.set_similarities(), **features.weighted_similarities()})
    rows = rows.withColumns({**features.interactions(), **features.more_interactions()})
    numbers = ("name_addr_prod", "name_idf_addr_prod", "name_country_prod", "name_has_pincode_prod", "name_addr_char_prod")
    flags = ("high_name_pin_mismatch", "name_match_addr_mismatch", "same_address_other_name", "same_branch_number", "low_information_name")
    return rows.select("s1_id", "cand_id", *(F.round(c, 6).alias(c) for c in numbers), *flags)


def rank_window_features(spark, folder):
    rows = features.group_features(scored_pairs(spark, folder), "score")
    ints = ("cand_rank", "cand_count_for_s1")
    return rows.select("s1_id", "cand_id", *(F.col(c).cast("long").alias(c) for c in ints), *(F.round(c, 6).alias(c) for c in features.GROUP_FEATURES if c not in ints))


def gap_to_second(spark, folder):
    rows = features.gap_to_second(scored_pairs(spark, folder), "score")
    return rows.select("s1_id", "cand_id", F.round("second_best", 6).alias("second_best"), F.round("lead_of_best", 6).alias("lead_of_best"))


def translit_rewrite(spark, folder):
    rows = attributed_pairs(spark, folder).filter("country_norm_1 = 'INDIA' or country_norm_2 = 'INDIA'")
    return rows.select("s1_id", "cand_id", S.variant_rewritten(F.col("name_core_1"), F.col("name_core_2")).alias("rewritten"))


def translit_pattern_counts(spark, folder):
    left, right = _both(spark, folder)
    return variants.variant_counts(left, right, truth(spark, folder))


def seq_ratio_features(spark, folder):
    return attributed_pairs(spark, folder).select("s1_id", "cand_id", *_rounded(features.sequence_similarities()))


def token_set_ratio_pairs(spark, folder):
    return attributed_pairs(spark, folder).select("s1_id", "cand_id", F.round(S.token_set_ratio(F.col("name_norm_1"), F.col("name_norm_2")), 6).alias("token_set_ratio"))


def jaro_winkler_pairs(spark, folder):
    return attributed_pairs(spark, folder).select("s1_id", "cand_id", F.round(S.jaro_winkler_ratio(F.col("name_norm_1"), F.col("name_norm_2")), 6).alias("jaro_winkler"))


def pair_feature_matrix(spark, folder):
    return features.feature_matrix(scored_pairs(spark, folder).select("s1_id", "cand_id"), *_both(spark, folder), _weights(spark, folder))


# ---------------------------------------------------------------- decisions

THRESHOLD = 0.5


def greedy_assignment(spark, folder):
    return decide.assign(scored_pairs(spark, folder), THRESHOLD).select("s1_id", "cand_id", "score")


def confidence_propagation(spark, folder):
    return decide.lost_confidence(scored_pairs(spark, folder), THRESHOLD).select("s1_id", "cand_id", "score", "losses")


def _assigned(spark, folder):
    return decide.assign(scored_pairs(spark, folder), THRESHOLD)


def matching_lists(spark, folder):
    return id_lists(_assigned(spark, folder), left_records(spark, folder), "matched_entity_ids")


def match_counts(spark, folder):
    lists = matching_lists(spark, folder)
    return lists.agg(F.count_if(F.col("matched_entity_ids") != "").alias("matched"), F.count_if(F.col("matched_entity_ids") == "").alias("single"))


def entity_f05(spark, folder):
    rows = decide.record_scores(_assigned(spark, folder), truth(spark, folder))
    return rows.select("s1_id", "n_pred", "n_true", "n_hit", F.round("f05", 6).alias("f05"))


def macro_f05(spark, folder):
    return decide.macro_f_half(_assigned(spark, folder), truth(spark, folder)).select(F.round("macro_f05", 6).alias("macro_f05"))


def threshold_curve(spark, folder):
    rows = decide.threshold_curve(scored_pairs(spark, folder), truth(spark, folder))
    return rows.select(F.round("threshold", 4).alias("threshold"), F.round("macro_f05", 6).alias("macro_f05"))


def best_threshold(spark, folder):
    rows = decide.best_threshold(scored_pairs(spark, folder), truth(spark, folder))
    return rows.select(F.round("threshold", 4).alias("threshold"), F.round("macro_f05", 6).alias("macro_f05"))


def bucket_thresholds(spark, folder):
    left = T.normalized(left_records(spark, folder)).select(F.col("entity_id").alias("s1_id"), F.when(F.col("has_address") == 1, "address").otherwise("no address").alias("bucket"))
    rows = decide.bucket_thresholds(scored_pairs(spark, folder), truth(spark, folder), left)
    return rows.select("bucket", "records", F.round("threshold", 4).alias("threshold"))


def singleton_report(spark, folder):
    return decide.single_report(_assigned(spark, folder), truth(spark, folder))


def training_pairs(spark, folder):
    return decide.training_pairs(scored_pairs(spark, folder), truth(spark, folder))


def class_balance(spark, folder):
    return decide.class_balance(training_pairs(spark, folder)).withColumn("positive_weight", F.round("positive_weight", 6))


def val_split(spark, folder):
    return decide.validation_split(left_records(spark, folder).select(F.col("entity_id").alias("s1_id")).distinct())


def sampled_records(spark, folder):
    return decide.sample_records(left_records(spark, folder).select("entity_id").distinct(), 500)


def hard_negatives(spark, folder):
    from tallyweave.operators.model import hard_negatives as worst

    wanted = truth(spark, folder)
    pairs = scored_pairs(spark, folder).join(wanted, "s1_id")
    return worst(pairs.select("s1_id", "cand_id", "score", F.array_contains("targets", F.col("cand_id")).cast("int").alias("label")), score="score").select("s1_id", "cand_id", "score")


def _labelled_matrix(spark, folder, both: list[DataFrame] | None = None, weights: idf.WordWeights | None = None) -> DataFrame:
    """Features, label and split of the labelled records' candidate pairs; ``both`` and ``weights`` are made unless they are given."""
    left, right = both or _both(spark, folder)
    labelled = truth(spark, folder)
    mine = left.join(labelled.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_semi")
    pairs = decide.training_pairs(blocking.rule_candidates(mine, right), labelled)
    rows = decide.validation_split(pairs).join(left.select(F.col("entity_id").alias("s1_id"), "country_key").dropDuplicates(["s1_id"]), "s1_id")
    return cut(features.feature_matrix(rows, left, right, weights or _weights(spark, folder)), "training")


def _learned(spark, folder) -> tuple[DataFrame, DataFrame]:
    matrix = _labelled_matrix(spark, folder)
    ensemble = model.PairEnsemble().fit(matrix)
    return ensemble.score(matrix.filter("is_val")), matrix


def ensemble_scores(spark, folder):
    """Validation pairs of the labelled records scored by the trained ensemble."""
    scored, _ = _learned(spark, folder)
    return scored.select("s1_id", "cand_id", "label", "proba")


def end_to_end_matches(spark, folder):
    """Matches of all left records by the whole pipeline, of all pairs that share a key and with all labels."""
    options = pipeline.Options(sample_train=0, per_key=None, per_record=None)
    matches, _, _ = pipeline.link(left_records(spark, folder), right_records(spark, folder), truth(spark, folder), options)
    return matches


def calibrated_scores(spark, folder):
    """Validation pairs with the ensemble's probability and its isotonic calibration."""
    scored, _ = _learned(spark, folder)
    scored = cut(scored.select("s1_id", "cand_id", "label", "proba"), "scored")
    return model.calibrated(scored, scored).select("s1_id", "cand_id", "label", "proba", "proba_calibrated")


def split_view_scores(spark, folder):
    """Validation pairs scored by members that see names, addresses and everything."""
    matrix = _labelled_matrix(spark, folder)
    return model.name_address_ensemble().fit(matrix).score(matrix.filter("is_val")).select("s1_id", "cand_id", "label", "proba")


def country_held_out_scores(spark, folder):
    """Every labelled pair scored by an ensemble that never saw its country."""
    return model.leave_one_country_out(_labelled_matrix(spark, folder)).select("s1_id", "cand_id", "label", "held_out", "proba")


def pseudo_label_scores(spark, folder):
    """Validation pairs scored after rounds of training on confidently scored pairs of unlabelled records."""
    left, right = both = _both(spark, folder)
    weights = _weights(spark, folder)
    matrix = _labelled_matrix(spark, folder, both, weights)
    others = left.join(truth(spark, folder).select(F.col("s1_id").alias("entity_id")), "entity_id", "left_anti")
    pairs = cut(blocking.rule_candidates(others, right), "pairs")
    pool = cut(features.feature_matrix(pairs, left, right, weights), "pool")
    ensemble, _ = model.pseudo_label_rounds(matrix, pool)
    return ensemble.score(matrix.filter("is_val")).select("s1_id", "cand_id", "label", "proba")


def seed_averaged_f05(spark, folder):
    """Macro F0.5 of the given scores on validation records of several splits, and their mean."""
    return decide.averaged_over_seeds(scored_pairs(spark, folder), truth(spark, folder), THRESHOLD).select("seed", "records", F.round("macro_f05", 6).alias("macro_f05"))


def cluster_split(spark, folder):
    """Labelled records split so that records joined by true matches stay on one side."""
    return cluster.cluster_split(truth(spark, folder))


# ---------------------------------------------------------------- validation and groups


def _result_lines(spark, folder) -> DataFrame:
    """Rows of ``candidate_pairs`` as parsed result lines; a null list is a line without a tab."""
    rows = table(spark, folder, "candidate_pairs")
    ids = F.col("candidate_entity_ids")
    lists = F.when(F.trim(ids) == "", F.array().cast("array<string>")).otherwise(F.split(ids, ","))
    return rows.select(F.col("source1_entity_id").alias("s1_id"), F.col("source1_entity_id").alias("line"), ids.isNotNull().alias("ok"), F.coalesce(lists, F.array().cast("array<string>")).alias("ids"))


def validate_rules(spark, folder):
    required = table(spark, folder, "train_source1").select(F.col("entity_id").alias("s1_id")).distinct()
    known = table(spark, folder, "train_source2").select(F.col("entity_id").alias("id")).union(table(spark, folder, "train_source3").select("entity_id")).distinct()
    return validate.broken_rules(_result_lines(spark, folder), required, known)


def validate_summary(spark, folder):
    return validate.summary(validate_rules(spark, folder))


def outside_candidates(spark, folder):
    mine = truth(spark, folder).select("s1_id", F.col("targets").alias("ids"))
    lists = scored_pairs(spark, folder).groupBy("s1_id").agg(F.collect_set("cand_id").alias("ids"))
    return validate.outside_candidates(mine, lists)


def gt_components(spark, folder):
    return cluster.truth_components(truth(spark, folder))


def country_label_clusters(spark, folder):
    every = table(spark, folder, "train_source1").select("country").union(table(spark, folder, "train_source2").select("country")).union(table(spark, folder, "train_source3").select("country"))
    return cluster.label_clusters(every, "country")


def embedding_topk_cosine(spark, folder):
    vectors = table(spark, folder, "embeddings").select("vec_id", "embedding")
    rows = retrieval.cosine_neighbours(vectors, vectors.filter("vec_id % 20 = 0"))
    return rows.select("query_id", "vec_id", F.round("score", 5).alias("score"), F.col("rank").cast("long").alias("rank"))


QUERIES: tuple[Callable, ...] = (
    normalize_names, normalize_addresses, normalize_addresses_indian, retrieval_text, parsed_truth, record_flags,
    block_union_capped, candidate_lists, block_sound, block_place, tfidf_top20, bm25_top20, tfidf_cosine_pairs, minhash_candidates, hybrid_candidates, blocking_recall, hybrid_recall, reduction_ratio, fn_mining,
    idf_table, weighted_jaccard_pairs, token_jaccard_pairs, char3_jaccard_pairs, len_ratios, structured_pair_features, raw_suffix_pairs, landmark_pairs, interaction_flags,
    rank_window_features, gap_to_second, translit_rewrite, translit_pattern_counts, seq_ratio_features, token_set_ratio_pairs, jaro_winkler_pairs, pair_feature_matrix,
    greedy_assignment, confidence_propagation, matching_lists, match_counts, entity_f05, macro_f05, threshold_curve, best_threshold, bucket_thresholds, singleton_report,
    training_pairs, class_balance, val_split, sampled_records, hard_negatives, ensemble_scores, calibrated_scores, split_view_scores, country_held_out_scores, pseudo_label_scores, seed_averaged_f05, cluster_split, end_to_end_matches,
    validate_rules, validate_summary, outside_candidates, gt_components, country_label_clusters, embedding_topk_cosine,
)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    blocks = {f"block_{kind}": _block(kind) for kind in blocking.KEY_TYPES}
    return {q.__name__: q for q in QUERIES} | blocks


def oracle_sql() -> dict[str, str]:
    return oracle.statements()
