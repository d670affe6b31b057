"""Groups of linked records and of label variants."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.decide import by_digest
from tallyweave.plans.durable import cut


def components(links: DataFrame, rounds: int = 40) -> DataFrame:
    """``(node, component)`` of links ``(a, b)``: the smallest node that can be reached.

    Stars alternate between large and small neighbours, which halves the way to
    the smallest node in each round; every round is cut by a table, and none
    gathers a component anywhere. Rounds go on until nothing moves; more than
    ``rounds``, far above the logarithm of any size, are an error.
    """
    edges = links.select("a", "b").filter("a is not null and b is not null and a <> b").distinct()
    nodes = links.select(F.col("a").alias("node")).union(links.select("b")).filter("node is not null").distinct()
    edges = cut(edges.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    for done in range(rounds + 1):
        if done == rounds:
            raise RuntimeError(f"components did not settle in {rounds} rounds")
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(least, "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()
        down = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(down, "u").select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct(F.col("u").alias("u"), F.col("m").alias("v")))).alias("x")).select("x.*").filter("u <> v").distinct()
        fresh = cut(small, "edges")
        same = fresh.count() == edges.count() and fresh.join(edges, ["u", "v"], "left_anti").isEmpty()
        edges = fresh
        if same:
            break
    return nodes.join(edges.select(F.col("u").alias("node"), F.col("v").alias("component")), "node", "left").select("node", F.coalesce("component", "node").alias("component"))


def truth_components(truth: DataFrame) -> DataFrame:
    """Components of records linked by true matches, for splits that keep them whole."""
    links = truth.select(F.col("s1_id").alias("a"), F.explode_outer("targets").alias("b"))
    return components(links.select("a", F.coalesce("b", "a").alias("b")))


def cluster_split(truth: DataFrame, share: float = 0.2, seed: int = 42) -> DataFrame:
    """``(s1_id, component, is_val)``: records of one component of true matches all go to the same side."""
    parts = truth_components(truth).withColumnRenamed("node", "s1_id").join(truth.select("s1_id").distinct(), "s1_id", "left_semi")
    return parts.withColumn("is_val", by_digest(F.col("component"), seed) < share)


def label_clusters(labels: DataFrame, column: str) -> DataFrame:
    """``(label, n, cluster)``: distinct labels joined where their letters are equal or, beyond three letters, one edit apart.

    A cluster has the name of its most frequent label. Labels meet on their letters
    with at most one left out, which finds every pair one edit apart by equality.
    Null and blank labels are no labels.
    """
    counted = labels.filter(F.trim(F.coalesce(F.col(column), F.lit(""))) != "").groupBy(F.trim(F.col(column)).alias("label")).agg(F.count("*").alias("n"))
    counted = cut(counted.withColumn("letters", F.lower(F.regexp_replace("label", r"[^\p{L}]", ""))), "labels")
    letters = F.col("letters")
    left_out = F.transform(F.sequence(F.lit(1), F.length(letters)), lambda i: F.concat(F.substr(letters, F.lit(1), i - 1), F.substr(letters, i + 1)))
    keys = F.when(F.length(letters) > 3, F.array_distinct(F.concat(F.array(letters), left_out))).otherwise(F.array(letters))
    keyed = counted.select("label", "letters", F.explode(keys).alias("key"))
    near = keyed.alias("x").join(keyed.alias("y"), "key").filter("x.label < y.label").filter((F.col("x.letters") == F.col("y.letters")) | (F.levenshtein(F.col("x.letters"), F.col("y.letters")) <= 1))
    links = near.select(F.col("x.label").alias("a"), F.col("y.label").alias("b")).union(counted.select("label", "label")).distinct()
    parts = components(links).join(counted, F.col("node") == F.col("label")).select("label", "n", "component")
    names = parts.groupBy("component").agg(F.max(F.struct("n", "label")).alias("top")).select("component", F.col("top.label").alias("cluster"))
    return parts.join(names, "component").select("label", "n", "cluster")
