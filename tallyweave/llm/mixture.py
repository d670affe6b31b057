"""Mix sources to target shares by a low-discrepancy schedule of equal-token blocks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyweave.llm.tokens import token_sizes
from tallyweave.plans.durable import cut

#: Slots of the schedule: a fixed number, so the schedule is small at any corpus
#: size and a share is met to about 1 / SLOTS.
SLOTS = 16_384
#: Rows of one source and round that are ordered by one task.
ROWS_PER_BUCKET = 50_000
#: Fractional part of the golden ratio.
GOLDEN = 0.6180339887498949


def plan_sources(sizes: DataFrame, targets: DataFrame, total: int) -> DataFrame:
    """One row per listed source: target and available tokens and the rounds over its texts."""
    have = _texts(sizes, targets).groupBy("source").agg(F.sum("n_tokens").alias("available"), F.count("*").alias("n_texts"))
    need = F.ceil(F.col("target_share") * F.lit(total) / F.greatest(F.col("available"), F.lit(1)))
    return _listed(targets).join(have, "source", "left").na.fill(0, ["available", "n_texts"]).select(
        "source", "target_share", "max_repeats", "available", "n_texts",
        F.when(F.col("available") > 0, F.least(F.col("max_repeats").cast("long"), need)).otherwise(F.lit(0)).cast("int").alias("rounds"),
    )


def _listed(targets: DataFrame) -> DataFrame:
    """The usable rows of the target table, one per source."""
    good = targets.filter("source is not null and target_share > 0 and max_repeats > 0")
    return good.groupBy("source").agg(F.max("target_share").alias("target_share"), F.max("max_repeats").alias("max_repeats"))


def _texts(sizes: DataFrame, targets: DataFrame) -> DataFrame:
    """Distinct non-empty texts of listed sources; a text found in several belongs to its smallest doc_id."""
    listed = sizes.filter("n_tokens > 0 and source is not null").join(_listed(targets).select("source"), "source", "left_semi")
    return listed.groupBy("text_key").agg(F.min(F.struct("doc_id", "source", "n_tokens")).alias("t")).select("t.*", "text_key")


def mixture(documents: DataFrame, targets: DataFrame, seed: int = 7, slots: int = SLOTS, vocabulary: str | None = None) -> DataFrame:
    """Rows ``(slot, source, doc_id, repeat, n_tokens)`` of the mixture, to be read in order of slot.

    The mixture aims at as many tokens as all documents hold. Slot i takes the
    source into whose interval of cumulated shares the golden-ratio point of i
    falls; the k-th slot of a source takes the k-th block of equal token count
    of its shuffled texts, a new shuffle for every round. A text lies in the
    block in which it starts and is used at most ``max_repeats`` times; equal
    texts are one text. A source without texts, or whose texts are used up,
    leaves its slots empty, and :func:`shares` reports that. Null and empty
    texts have no tokens and never appear; documents without a listed source
    count for the total only. Empty tables give an empty result.
    """
    sizes = cut(token_sizes(documents, vocabulary), "sizes")
    return _schedule(sizes, targets, seed, slots)[0]


def _schedule(sizes: DataFrame, targets: DataFrame, seed: int, slots: int) -> tuple[DataFrame, DataFrame]:
    spark = sizes.sparkSession
    total = sizes.agg(F.sum("n_tokens")).first()[0] or 0
    plan = cut(plan_sources(sizes, targets, total).repartition(1), "plan")

    # A window over the few listed sources: their intervals of cumulated shares.
    by_name = Window.orderBy("source")
    share = F.col("target_share") / F.sum("target_share").over(Window.partitionBy())
    spans = plan.select("source", share.alias("share")).withColumn("high", F.sum("share").over(by_name))
    spans = spans.select("source", (F.col("high") - F.col("share")).alias("low"), F.when(F.row_number().over(Window.orderBy(F.desc("source"))) == 1, 2.0).otherwise(F.col("high")).alias("high"))
    points = spark.range(slots).select(F.col("id").alias("slot"), (F.col("id") * GOLDEN % 1.0).alias("u"))
    ranked = points.join(spans, (points.u >= spans.low) & (points.u < spans.high)).select(
        "slot", "source", (F.row_number().over(Window.partitionBy("source").orderBy("slot")) - 1).cast("long").alias("rank")
    )

    texts = _texts(sizes, targets).join(plan.select("source", "rounds", "n_texts"), "source")
    uses = texts.select("source", "doc_id", "n_tokens", "n_texts", "text_key", F.explode(F.sequence(F.lit(0), F.col("rounds") - 1)).alias("repeat"))
    uses = uses.withColumn("order", F.xxhash64(F.lit(seed), "repeat", "text_key"))
    buckets = F.ceil(F.col("n_texts") / ROWS_PER_BUCKET)
    uses = uses.select("source", "doc_id", "n_tokens", "repeat", "order", F.pmod(F.shiftrightunsigned("order", 20), buckets).alias("bucket"))

    # Prefix sums in two levels: over the buckets of a source, then inside each bucket.
    sums = uses.groupBy("source", "repeat", "bucket").agg(F.sum("n_tokens").alias("n"))
    before = F.sum("n").over(Window.partitionBy("source").orderBy("repeat", "bucket")) - F.col("n")
    starts = sums.select("source", "repeat", "bucket", before.alias("before"))
    inside = F.sum("n_tokens").over(Window.partitionBy("source", "repeat", "bucket").orderBy("order", "doc_id")) - F.col("n_tokens")
    placed = uses.withColumn("inside", inside).join(starts, ["source", "repeat", "bucket"])
    placed = placed.select("source", "doc_id", "repeat", "n_tokens", F.floor((F.col("before") + F.col("inside")) * slots / max(1, total)).alias("rank"))
    return placed.join(ranked, ["source", "rank"]).select("slot", "source", "doc_id", "repeat", "n_tokens"), plan


def shares(documents: DataFrame, targets: DataFrame, seed: int = 7, slots: int = SLOTS, vocabulary: str | None = None) -> DataFrame:
    """One row per listed source with its target and actual share of the mixture.

    ``actual_share`` is of the tokens in the mixture, ``share_of_total`` of the
    tokens of all documents; ``times_used`` is the most any text was used.
    """
    sizes = cut(token_sizes(documents, vocabulary), "sizes")
    rows, plan = _schedule(sizes, targets, seed, slots)
    total = sizes.agg(F.sum("n_tokens").alias("corpus_tokens"))
    used = rows.groupBy("source").agg(F.sum("n_tokens").alias("tokens"), (F.max("repeat") + 1).alias("times_used"))
    out = plan.join(used, "source", "left").na.fill(0, ["tokens", "times_used"]).crossJoin(F.broadcast(total))  # one row
    mixed = F.sum("tokens").over(Window.partitionBy())
    return out.select(
        "source", "target_share", "max_repeats", "available", "tokens", "times_used",
        F.when(mixed > 0, F.col("tokens") / mixed).otherwise(0.0).alias("actual_share"),
        F.when(F.col("corpus_tokens") > 0, F.col("tokens") / F.col("corpus_tokens")).otherwise(0.0).alias("share_of_total"),
    )
