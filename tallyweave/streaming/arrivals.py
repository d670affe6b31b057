"""Link records as they arrive against a static table."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.functions import similarity as S
from tallyweave.functions.text import normalized
from tallyweave.operators.blocking import key_array


def late_records_once(arrivals: DataFrame, delay: str = "30 days", time: str = "loaded_at") -> DataFrame:
    """Repeated deliveries of a record dropped while they arrive within ``delay`` of each other."""
    return arrivals.withWatermark(time, delay).dropDuplicatesWithinWatermark(["entity_id"])


def streamed_candidates(arrivals: DataFrame, reference: DataFrame, kinds: tuple[str, ...] = ("pincode", "prefix6", "bigram"), least: float = 0.5) -> DataFrame:
    """``(s1_id, cand_id, name_set)`` of arriving raw records and a static, normalized reference table.

    One stream-static join on blocking keys, through which the arriving record
    carries its own name; pairs whose names share at least ``least`` of their words
    are kept, a pair once for every key it shares. Works on a batch table too.
    """
    fresh = normalized(arrivals).select(F.col("entity_id").alias("cand_id"), F.col("name_norm").alias("name_2"), "country_norm", F.explode(key_array()).alias("k"))
    fresh = fresh.select("cand_id", "name_2", "country_norm", "k.*").filter(F.col("key_type").isin(*kinds))
    mine = reference.select(F.col("entity_id").alias("s1_id"), F.col("name_norm").alias("name_1"), "country_norm", F.explode(key_array()).alias("k")).select("s1_id", "name_1", "country_norm", "k.*")
    pairs = fresh.join(mine, ["country_norm", "key_type", "key"])
    return pairs.select("s1_id", "cand_id", S.token_jaccard(F.col("name_1"), F.col("name_2")).alias("name_set")).filter(F.col("name_set") >= least)
