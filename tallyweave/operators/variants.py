"""Spelling variants of transliterated names, mined from true pairs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import vocabulary as V

#: Labelled records that are mined at most, in order of id.
MINED = 50_000


def variant_counts(left: DataFrame, right: DataFrame, truth: DataFrame, country: str = "INDIA", most: int | None = MINED) -> DataFrame:
    """``(a, b, n)``: true pairs of different names where the left has ``a`` and the right ``b``, zeros included; ``most`` None mines all labelled records."""
    mine = left.filter(F.col("country_norm") == country).select(F.col("entity_id").alias("s1_id"), F.col("name_norm").alias("x"))
    labelled = truth.join(mine.select("s1_id"), "s1_id", "left_semi")
    if most is not None:
        labelled = labelled.orderBy("s1_id").limit(most)
    pairs = labelled.select("s1_id", F.explode("targets").alias("cand_id")).distinct().join(mine, "s1_id").join(right.select(F.col("entity_id").alias("cand_id"), F.col("name_norm").alias("y")), "cand_id")
    pairs = pairs.filter("x <> '' and y <> '' and x <> y")
    held = F.array(*(F.when(F.col("x").contains(a) & F.col("y").contains(b), k) for k, (a, b, _) in enumerate(V.VARIANTS)))
    counts = pairs.select(F.explode(F.filter(held, lambda k: k.isNotNull())).alias("k")).groupBy("k").agg(F.count("*").alias("n"))
    table = left.sparkSession.createDataFrame([(k, a, b) for k, (a, b, _) in enumerate(V.VARIANTS)], "k int, a string, b string")
    return table.join(counts, "k", "left").select("a", "b", F.coalesce("n", F.lit(0)).alias("n"))
