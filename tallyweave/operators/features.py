"""The feature matrix of candidate pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyweave.functions import similarity as S
from tallyweave.functions.text import tokens
from tallyweave.operators.idf import WordWeights

ATTRIBUTES = ("name_norm", "name_core", "name_sorted", "core_sorted", "address_norm", "addr_token1", "pincode", "street_num", "legal_suffix", "country_norm", "has_pincode", "has_address", "has_landmark", "name_len", "name_ntoken")
WEIGHTED = ("name_norm", "name_core", "address_norm")

# Parts of the composite similarity.
COMPOSITE = {"name_idf_jaccard": 0.35, "core_lev": 0.20, "name_sort": 0.15, "addr_set": 0.15, "pincode_exact_match": 0.10, "translit_sim": 0.05}

PAIR_FEATURES = (
    "name_lev", "name_sort", "name_set", "name_char3", "name_idf_jaccard", "name_len_ratio", "name_ntoken_ratio",
    "core_lev", "core_sort", "core_set", "core_sorted_sim", "core_idf", "core_len_ratio",
    "addr_lev", "addr_set", "addr_char3", "addr_idf_jaccard", "addr_token_match", "translit_sim",
    "country_match", "country_mismatch", "pincode_exact_match", "pincode_prefix_match", "both_has_pincode", "one_missing_pincode",
    "street_num_match", "suffix_match", "suffix_mismatch", "both_has_address", "has_landmark_s1", "has_landmark_s23",
    "name_addr_prod", "name_idf_addr_prod", "high_name_pin_mismatch", "name_match_addr_mismatch",
)
GROUP_FEATURES = ("cand_rank", "max_sim_for_s1", "min_sim_for_s1", "mean_sim_for_s1", "cand_count_for_s1", "sim_gap_to_best", "sim_percentile", "sim_gap_norm")
FEATURES = (*PAIR_FEATURES, "composite_sim", *GROUP_FEATURES)


def with_attributes(pairs: DataFrame, left: DataFrame, right: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """Pairs whose two records exist, with ``<column>_1`` and ``<column>_2``; columns of ``pairs`` other than the ids are kept."""
    a = left.select(F.col("entity_id").alias("s1_id"), *(F.col(c).alias(f"{c}_1") for c in columns))
    b = right.select(F.col("entity_id").alias("cand_id"), *(F.col(c).alias(f"{c}_2") for c in columns))
    return pairs.join(a, "s1_id").join(b, "cand_id")


def _two(c: str) -> tuple[Column, Column]:
    return F.col(f"{c}_1"), F.col(f"{c}_2")


def _flag(condition: Column) -> Column:
    return F.coalesce(condition, F.lit(False)).cast("int")


def _both_equal(c: str) -> Column:
    a, b = _two(c)
    return _flag((a != "") & (b != "") & (a == b))


def structured() -> dict[str, Column]:
    """Features of pairs that compare parsed parts only."""
    pin_a, pin_b = _two("pincode")
    both = (F.col("has_pincode_1") == 1) & (F.col("has_pincode_2") == 1)
    country_a, country_b = _two("country_norm")
    suffix_a, suffix_b = _two("legal_suffix")
    return {
        "addr_token_match": _both_equal("addr_token1"),
        "country_match": _flag(country_a == country_b),
        "country_mismatch": _flag(country_a != country_b),
        "pincode_exact_match": _flag(both & (pin_a == pin_b)),
        "pincode_prefix_match": _flag(both & (F.substring(pin_a, 1, 3) == F.substring(pin_b, 1, 3))),
        "both_has_pincode": _flag(both),
        "one_missing_pincode": _flag(F.col("has_pincode_1") != F.col("has_pincode_2")),
        "street_num_match": _both_equal("street_num"),
        "suffix_match": _both_equal("legal_suffix"),
        "suffix_mismatch": _flag((suffix_a != "") & (suffix_b != "") & (suffix_a != suffix_b)),
        "both_has_address": _flag((F.col("has_address_1") == 1) & (F.col("has_address_2") == 1)),
        "has_landmark_s1": F.col("has_landmark_1"),
        "has_landmark_s23": F.col("has_landmark_2"),
    }


#: Sets that are made once for each record and compared for each pair.
SETS = ("name_norm_words", "name_core_words", "address_norm_words", "name_norm_grams", "address_norm_grams")


def with_sets(records: DataFrame) -> DataFrame:
    """Records with the :data:`SETS` of words and character 3-grams of their texts, as digests."""
    texts = ("name_norm", "name_core", "address_norm")
    words = {f"{c}_words": S.hashed(tokens(F.col(c))) for c in texts}
    return records.withColumns({**words, **{f"{c}_grams": S.hashed(S.char_ngrams(F.col(c))) for c in texts if c != "name_core"}})


def set_similarities() -> dict[str, Column]:
    """Features of pairs that need no Python: :data:`SETS` of words and grams, lengths."""
    sets = {"name_set": "name_norm_words", "core_set": "name_core_words", "addr_set": "address_norm_words", "name_char3": "name_norm_grams", "addr_char3": "address_norm_grams"}
    return {
        **{feature: S.set_jaccard(*_two(c)) for feature, c in sets.items()},
        "name_len_ratio": S.length_ratio(*_two("name_norm")),
        "core_len_ratio": S.length_ratio(*_two("name_core")),
        "name_ntoken_ratio": S.token_count_ratio(*_two("name_ntoken")),
    }


def weighted_similarities() -> dict[str, Column]:
    return {out: S.weighted_jaccard(*_two(f"{c}_weights")) for out, c in zip(("name_idf_jaccard", "core_idf", "addr_idf_jaccard"), WEIGHTED, strict=True)}


def _india() -> Column:
    return (F.col("country_norm_1") == "INDIA") | (F.col("country_norm_2") == "INDIA")


def _rewritten() -> Column:
    return F.when(_india(), S.variant_rewritten(*_two("name_core")))


def sequence_similarities(rewritten: Column | None = None) -> dict[str, Column]:
    """Features by matching sequences; the core's sorted form is compared once for both of its names.

    ``rewritten`` is the right core with the left one's spelling variants, null outside of India, where it is known already.
    """
    core_a, core_b = _two("name_core")
    ratios = S.sequence_ratios({
        "name_lev": _two("name_norm"),
        "name_sort": _two("name_sorted"),
        "core_lev": _two("name_core"),
        "core_sort": _two("core_sorted"),
        "addr_lev": _two("address_norm"),
        "variant_sim": (core_a, _rewritten() if rewritten is None else rewritten),
    })
    variant = F.when((core_a == "") | (core_b == ""), 0.0).when(core_a == core_b, 1.0).otherwise(ratios["variant_sim"])
    return {**ratios, "variant_sim": variant}


def interactions() -> dict[str, Column]:
    return {
        "name_addr_prod": F.col("name_set") * F.col("addr_set"),
        "name_idf_addr_prod": F.col("name_idf_jaccard") * F.col("addr_set"),
        "high_name_pin_mismatch": _flag((F.col("name_set") > 0.8) & (F.col("both_has_pincode") == 1) & (F.col("pincode_exact_match") == 0)),
        "name_match_addr_mismatch": _flag((F.col("name_set") > 0.7) & (F.col("addr_set") < 0.2)),
    }


def more_interactions() -> dict[str, Column]:
    """Further products and flags, not part of the model's features."""
    name_a, name_b = _two("name_norm")
    digits = lambda c: F.array_distinct(F.regexp_extract_all(c, F.lit(r"(\d+)"), F.lit(1)))
    return {
        "name_country_prod": F.col("name_set") * F.col("country_match"),
        "name_has_pincode_prod": F.col("name_set") * F.col("both_has_pincode"),
        "name_addr_char_prod": F.col("name_char3") * F.col("addr_char3"),
        "same_address_other_name": _flag((F.col("addr_set") > 0.8) & (F.col("name_set") < 0.2)),
        "same_branch_number": _flag(F.size(F.array_intersect(digits(name_a), digits(name_b))) > 0),
        "low_information_name": _flag((F.length("name_core_1") < 3) | (F.length("name_core_2") < 3)),
    }


def composite() -> Column:
    return sum(F.col(c) * w for c, w in COMPOSITE.items())


def group_features(pairs: DataFrame, score: str = "composite_sim") -> DataFrame:
    """Rank, spread and gaps of ``score`` among the candidates of each ``s1_id``: one shuffle for all."""
    mine = Window.partitionBy("s1_id")
    df = pairs.withColumns({
        "cand_rank": F.rank().over(mine.orderBy(F.desc(score))),
        "max_sim_for_s1": F.max(score).over(mine),
        "min_sim_for_s1": F.min(score).over(mine),
        "mean_sim_for_s1": F.avg(score).over(mine),
        "cand_count_for_s1": F.count(score).over(mine),
    })
    gap = F.col("max_sim_for_s1") - F.col(score)
    return df.withColumns({
        "sim_gap_to_best": gap,
        "sim_percentile": F.col("cand_rank") / F.col("cand_count_for_s1"),
        "sim_gap_norm": gap / (F.col("max_sim_for_s1") - F.col("min_sim_for_s1") + 1e-8),
    })


def gap_to_second(pairs: DataFrame, score: str = "composite_sim") -> DataFrame:
    """``second_best`` and the best candidate's lead over it; null for a single candidate."""
    mine = Window.partitionBy("s1_id").orderBy(F.desc(score), "cand_id").rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return pairs.withColumn("second_best", F.nth_value(score, 2).over(mine)).withColumn("lead_of_best", F.first(score).over(mine) - F.col("second_best"))


#: What a record brings to the features of its pairs.
DESCRIBED = (*ATTRIBUTES, *SETS, *(f"{c}_weights" for c in WEIGHTED))


def described(records: DataFrame, weights: WordWeights) -> DataFrame:
    """``entity_id`` and :data:`DESCRIBED` of normalized records."""
    return with_sets(weights.attach(records, WEIGHTED)).select("entity_id", *DESCRIBED)


def feature_matrix(pairs: DataFrame, left: DataFrame, right: DataFrame, weights: WordWeights) -> DataFrame:
    """``s1_id``, ``cand_id``, further columns of ``pairs`` and all :data:`FEATURES`.

    Pairs with an unknown record are left out; no pairs give an empty result.
    """
    return features_of(pairs, described(left, weights), described(right, weights))


def features_of(pairs: DataFrame, left: DataFrame, right: DataFrame, parts: int | None = None) -> DataFrame:
    """:func:`feature_matrix` of :func:`described` records; pairs with the texts of their records go through ``parts`` tasks where given, so that these can hold them."""
    keep = [c for c in pairs.columns if c not in ("s1_id", "cand_id")]
    if parts is None:
        df = with_attributes(pairs, left, right, DESCRIBED)
    else:
        a, b = (d.select(F.col("entity_id").alias(of), *(F.col(c).alias(f"{c}_{k}") for c in DESCRIBED)) for d, of, k in ((left, "s1_id", 1), (right, "cand_id", 2)))
        df = pairs.join(a, "s1_id").repartition(parts, "cand_id").join(b, "cand_id")
    # Sets and weights end here; only texts and figures of a pair go on to Python.
    df = df.withColumns({**structured(), **set_similarities(), **weighted_similarities(), "rewritten": _rewritten(), "india": _india()})
    df = df.withColumns({**sequence_similarities(F.col("rewritten")), **interactions()})
    df = df.withColumns({"core_sorted_sim": F.col("core_sort"), "translit_sim": F.when(F.col("india"), F.col("variant_sim")).otherwise(F.col("core_lev"))})
    df = df.withColumn("composite_sim", composite()).select("s1_id", "cand_id", *keep, *PAIR_FEATURES, "composite_sim")
    return group_features(df if parts is None else df.repartition(parts, "s1_id"))
