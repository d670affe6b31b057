"""Country labels typed in several ways, and which records they let meet."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyweave.plans.durable import cut

# Letters of labels that name no country.
NO_COUNTRY = ("na", "none", "null", "unknown")
#: Groups of records whose own country, or whose partner's, is not known.
ANY, OPEN = "*", "?"
#: Longest short form, and the part of the rows of all longer labels the one it stands for must hold.
SHORT, CLEAR = 3, 0.9
#: Distinct labels that are broadcast at most.
BROADCAST = 100_000


def letters(label: Column) -> Column:
    """Lower-case letters of a label; '' for null and for words that name no country."""
    low = F.lower(F.regexp_replace(F.coalesce(label, F.lit("")), r"[^\p{L}]", ""))
    return F.when(low.isin(*NO_COUNTRY), "").otherwise(low)


def country_keys(labels: DataFrame, column: str = "country_norm") -> DataFrame:
    """``(label, country_key)`` of distinct labels.

    Labels of equal letters are one country. A label of two or three letters stands for the
    longer one that begins with it, if that holds nearly all rows of such labels
    (US for USA, IN for India); else it is a country of its own.
    """
    counted = labels.groupBy(F.col(column).alias("label")).agg(F.count("*").alias("n")).withColumn("own", letters(F.col("label")))
    names = counted.filter("own <> ''").groupBy("own").agg(F.sum("n").alias("n"))
    starts = names.select(F.col("own").alias("long"), "n", F.explode(F.array(*(F.substring("own", 1, k) for k in range(2, SHORT + 1)))).alias("short")).filter("long <> short").distinct()
    of_short = Window.partitionBy("short")
    clear = starts.withColumns({"all": F.sum("n").over(of_short), "at": F.row_number().over(of_short.orderBy(F.desc("n"), "long"))}).filter(F.col("at") == 1).filter(F.col("n") >= CLEAR * F.col("all"))
    step = lambda at, to: clear.select(F.col("short").alias(at), F.col("long").alias(to))
    # Short forms get longer with every step, so two steps lead from two letters to the name.
    heads = names.join(step("own", "one"), "own", "left").join(step("one", "two"), "one", "left").select("own", F.coalesce("two", "one", "own").alias("head"))
    return counted.join(heads, "own", "left").select("label", F.coalesce("head", "own").alias("country_key"))


def with_country_keys(*tables: DataFrame) -> list[DataFrame]:
    """Normalized tables with ``country_key``, '' where no country is named; labels are compared over all tables together."""
    keys = cut(country_keys(reduce(DataFrame.union, [t.select("country_norm") for t in tables])).withColumnRenamed("label", "country_norm"), "countries")
    # One label can hold half of all rows, so a table small enough is broadcast; a larger one has no such label by far.
    if keys.count() <= BROADCAST:
        keys = F.broadcast(keys)
    return [t.drop("country_key").join(keys, "country_norm", "left").withColumn("country_key", F.coalesce("country_key", F.lit(""))) for t in tables]


def groups(right: bool) -> Column:
    """Groups a record meets the other side in: its country, and those of records without one.

    A record without a country meets all: a left one the group that holds every
    right record, a right one the group that every left record of a country asks.
    Each pair meets in one group and no record is in more than two.
    """
    known = F.col("country_key") != ""
    if right:
        return F.array(F.when(known, F.col("country_key")).otherwise(F.lit(OPEN)), F.lit(ANY))
    return F.when(known, F.array(F.col("country_key"), F.lit(OPEN))).otherwise(F.array(F.lit(ANY)))
