"""Inverse document frequencies of words."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.functions.text import tokens


@dataclass
class WordWeights:
    """Fitted weights ``(token, df, idf)`` and the weight of an unknown word."""

    table: DataFrame
    default: float

    def attach(self, records: DataFrame, columns: tuple[str, ...]) -> DataFrame:
        """Records with ``<column>_weights`` for each text column: ``words``, 64-bit digests of its distinct words, their ``idfs`` and the ``total`` of these.

        One pass over the distinct words of all columns together: exploded, joined
        to the weights by word and gathered again by record.
        """
        words = F.array(*(F.struct(F.lit(c).alias("c"), F.array_distinct(tokens(F.col(c))).alias("t")) for c in columns))
        long = records.select("entity_id", F.explode(words).alias("x")).select("entity_id", "x.c", F.explode("x.t").alias("token"))
        known = long.join(self.table.select("token", "idf"), "token", "left").select("entity_id", "c", F.struct("token", F.coalesce("idf", F.lit(self.default)).alias("idf")).alias("w"))
        gathered = known.groupBy("entity_id").agg(*(F.sort_array(F.collect_list(F.when(F.col("c") == c, F.col("w")))).alias(f"{c}_weights") for c in columns))
        empty = F.array().cast("array<struct<token:string,idf:double>>")

        def parts(c: str) -> Column:
            listed = F.coalesce(F.col(f"{c}_weights"), empty)
            words = F.transform(listed, lambda x: F.xxhash64(x["token"]))
            return F.struct(words.alias("words"), listed["idf"].alias("idfs"), F.aggregate(listed, F.lit(0.0), lambda s, x: s + x["idf"]).alias("total"))

        # Summed and hashed once for each record, not for each of its pairs.
        own = gathered.select("entity_id", *(parts(c).alias(f"{c}_weights") for c in columns))
        joined = records.join(own, "entity_id", "left")
        none = F.struct(F.array().cast("array<bigint>").alias("words"), F.array().cast("array<double>").alias("idfs"), F.lit(0.0).alias("total"))
        return joined.withColumns({f"{c}_weights": F.coalesce(F.col(f"{c}_weights"), none) for c in columns})


def idf_table(texts: DataFrame, column: str = "text") -> DataFrame:
    """``(token, df, idf)`` with idf = ln((N + 1) / (df + 1)) + 1; N counts empty texts too."""
    total = texts.agg(F.count("*").alias("n"))
    words = texts.select(F.explode(F.array_distinct(tokens(F.col(column)))).alias("token")).groupBy("token").agg(F.count("*").alias("df"))
    return words.crossJoin(F.broadcast(total)).select("token", "df", (F.log((F.col("n") + 1.0) / (F.col("df") + 1.0)) + 1.0).alias("idf"))  # one row


def fit(texts: DataFrame, column: str = "text") -> WordWeights:
    """Weights over the given texts only: pass training texts to keep test texts out, or both for the transductive form."""
    import math

    return WordWeights(idf_table(texts, column), math.log(texts.count() + 1.0) + 1.0)
