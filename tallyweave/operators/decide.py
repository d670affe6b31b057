"""Assignments, F0.5 scores and thresholds of scored pairs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Thresholds tried: 71 from 0.25 to 0.95.
LOW, HIGH, POINTS = 0.25, 0.95, 71
# What a search returns where nothing was scored.
NO_THRESHOLD, NO_SCORE = 0.5, -1.0


def thresholds() -> list[float]:
    return [LOW + k * ((HIGH - LOW) / (POINTS - 1)) if k < POINTS - 1 else HIGH for k in range(POINTS)]


def assign(scored: DataFrame, threshold: float, score: str = "score") -> DataFrame:
    """Pairs at or above ``threshold`` of which each candidate keeps its best record, ties by smaller ``s1_id``.

    Equal to claiming pairs in falling order of score, since only candidates are exclusive.
    """
    best = Window.partitionBy("cand_id").orderBy(F.desc(score), "s1_id")
    kept = scored.filter(F.col(score) >= threshold)
    return kept.withColumn("at", F.row_number().over(best)).filter("at = 1").drop("at")


def f_half(predicted: Column, true: Column, hit: Column) -> Column:
    """F0.5 of one record from its counts: 1 if both are empty, 0 if one is or nothing is hit."""
    p, r = F.try_divide(hit.cast("double"), predicted), F.try_divide(hit.cast("double"), true)
    return F.when((predicted == 0) & (true == 0), 1.0).when((predicted == 0) | (true == 0) | (hit == 0), 0.0).otherwise(1.25 * p * r / (0.25 * p + r))


def record_scores(matches: DataFrame, truth: DataFrame) -> DataFrame:
    """``(s1_id, n_pred, n_true, n_hit, f05)`` for every row of ``truth (s1_id, targets)``; missing matches are none."""
    pairs = matches.select("s1_id", "cand_id").distinct()
    wanted = truth.select("s1_id", F.explode("targets").alias("cand_id")).distinct().withColumn("hit", F.lit(1))
    found = pairs.join(wanted, ["s1_id", "cand_id"], "left").groupBy("s1_id").agg(F.count("*").alias("n_pred"), F.count("hit").alias("n_hit"))
    rows = truth.select("s1_id", F.size(F.array_distinct("targets")).alias("n_true")).join(found, "s1_id", "left").na.fill(0, ["n_pred", "n_hit"])
    return rows.select("s1_id", "n_pred", "n_true", "n_hit", f_half(F.col("n_pred"), F.col("n_true"), F.col("n_hit")).alias("f05"))


def macro_f_half(matches: DataFrame, truth: DataFrame) -> DataFrame:
    """Mean F0.5 over all rows of ``truth``; 0 for an empty one."""
    return record_scores(matches, truth).agg(F.coalesce(F.avg("f05"), F.lit(0.0)).alias("macro_f05"))


def threshold_curve(scored: DataFrame, truth: DataFrame, score: str = "score") -> DataFrame:
    """``(threshold, macro_f05)`` for all thresholds.

    Each pair is counted once, under the number of thresholds it passes; only
    those counts per record, at most one for each threshold, are cumulated.
    """
    grid = F.array(*map(F.lit, thresholds()))
    passed = F.size(F.filter(grid, lambda t: F.col(score) >= t))
    wanted = truth.select("s1_id", F.explode("targets").alias("cand_id")).distinct().withColumn("hit", F.lit(1))
    mine = scored.join(truth.select("s1_id"), "s1_id", "left_semi").groupBy("s1_id", "cand_id").agg(F.max(score).alias(score))
    levels = mine.join(wanted, ["s1_id", "cand_id"], "left").select("s1_id", passed.alias("level"), "hit").filter("level > 0")
    levels = levels.groupBy("s1_id", "level").agg(F.count("*").alias("n"), F.count("hit").alias("h"))
    # A record's scores at threshold k come from pairs of level above k.
    above = levels.select("s1_id", F.explode(F.sequence(F.lit(0), F.col("level") - 1)).alias("k"), "n", "h").groupBy("s1_id", "k").agg(F.sum("n").alias("n_pred"), F.sum("h").alias("n_hit"))
    sizes = truth.select("s1_id", F.size(F.array_distinct("targets")).alias("n_true"))
    scores = above.join(sizes, "s1_id").select("k", f_half(F.col("n_pred"), F.col("n_true"), F.col("n_hit")).alias("f"), F.when(F.col("n_true") == 0, 1).otherwise(0).alias("empty"))
    sums = scores.groupBy("k").agg(F.sum("f").alias("f"), F.sum("empty").alias("claimed"))
    totals = truth.agg(F.count("*").alias("n"), F.count_if(F.size("targets") == 0).alias("n_empty"))
    points = scored.sparkSession.createDataFrame(list(enumerate(thresholds())), "k int, threshold double")
    # Records without a pair at k score 1 if they have no match.
    out = points.join(F.broadcast(sums), "k", "left").crossJoin(F.broadcast(totals))  # 71 rows and one
    value = (F.coalesce("f", F.lit(0.0)) + F.col("n_empty") - F.coalesce("claimed", F.lit(0))) / F.col("n")
    return out.select("threshold", F.when(F.col("n") == 0, 0.0).otherwise(value).alias("macro_f05"))


def best_threshold(scored: DataFrame, truth: DataFrame, score: str = "score") -> DataFrame:
    """The smallest threshold of greatest macro F0.5, as one row."""
    curve = threshold_curve(scored, truth, score)
    return curve.orderBy(F.desc(F.round("macro_f05", 12)), "threshold").limit(1)


def single_report(matches: DataFrame, truth: DataFrame) -> DataFrame:
    """How many records without a true match were left without one."""
    rows = record_scores(matches, truth)
    return rows.agg(F.count_if((F.col("n_true") == 0) & (F.col("n_pred") == 0)).alias("correct_singles"), F.count_if(F.col("n_true") == 0).alias("true_singles"), F.count_if(F.col("n_pred") == 0).alias("predicted_singles"))


def bucket_thresholds(scored: DataFrame, truth: DataFrame, bucket: DataFrame, least: int = 30, score: str = "score") -> DataFrame:
    """``(bucket, threshold)``: the best threshold of each bucket of records ``(s1_id, bucket)``; one of fewer than ``least`` records gets the overall one."""
    overall = best_threshold(scored, truth, score).select(F.col("threshold").alias("overall"))
    cells = truth.join(bucket, "s1_id")
    sizes = cells.groupBy("bucket").agg(F.count("*").alias("records"), F.count_if(F.size("targets") == 0).alias("n_empty"))
    grid = scored.sparkSession.createDataFrame(list(enumerate(thresholds())), "k int, threshold double")
    wanted = truth.select("s1_id", F.explode("targets").alias("cand_id")).distinct().withColumn("hit", F.lit(1))
    passed = F.size(F.filter(F.array(*map(F.lit, thresholds())), lambda t: F.col(score) >= t))
    levels = scored.join(wanted, ["s1_id", "cand_id"], "left").select("s1_id", passed.alias("level"), "hit").filter("level > 0").groupBy("s1_id", "level").agg(F.count("*").alias("n"), F.count("hit").alias("h"))
    above = levels.select("s1_id", F.explode(F.sequence(F.lit(0), F.col("level") - 1)).alias("k"), "n", "h").groupBy("s1_id", "k").agg(F.sum("n").alias("n_pred"), F.sum("h").alias("n_hit"))
    rows = above.join(cells.select("s1_id", "bucket", F.size(F.array_distinct("targets")).alias("n_true")), "s1_id")
    sums = rows.groupBy("bucket", "k").agg(F.sum(f_half(F.col("n_pred"), F.col("n_true"), F.col("n_hit"))).alias("f"), F.count_if(F.col("n_true") == 0).alias("claimed"))
    every = sizes.crossJoin(F.broadcast(grid)).join(sums, ["bucket", "k"], "left")  # 71 rows a bucket
    value = (F.coalesce("f", F.lit(0.0)) + F.col("n_empty") - F.coalesce("claimed", F.lit(0))) / F.col("records")
    top = Window.partitionBy("bucket").orderBy(F.desc(F.round(value, 12)), "threshold")
    best = every.withColumn("at", F.row_number().over(top)).filter("at = 1")
    return best.crossJoin(overall).select("bucket", "records", F.when(F.col("records") < least, F.col("overall")).otherwise(F.col("threshold")).alias("threshold"))  # one row


def lost_confidence(scored: DataFrame, threshold: float, raise_by: float = 0.05, score: str = "score") -> DataFrame:
    """Assignments after a record that lost a candidate to another has to clear a raised threshold with the rest."""
    kept = scored.filter(F.col(score) >= threshold)
    best = Window.partitionBy("cand_id").orderBy(F.desc(score), "s1_id")
    placed = kept.withColumn("at", F.row_number().over(best))
    losses = F.sum(F.when(F.col("at") > 1, 1).otherwise(0)).over(Window.partitionBy("s1_id"))
    return placed.withColumn("losses", losses).filter(F.col("at") == 1).filter(F.col(score) >= threshold + F.when(F.col("losses") > 0, raise_by).otherwise(0.0)).drop("at")


def by_digest(c: Column, seed: int) -> Column:
    """A number from [0, 1) fixed by text and seed."""
    return F.conv(F.substring(F.md5(F.concat(c, F.lit(f"|{seed}"))), 1, 6), 16, 10).cast("double") / float(1 << 24)


def sample_records(records: DataFrame, n: int, seed: int = 42, key: str = "entity_id") -> DataFrame:
    """The ``n`` records of least digest: the same on every run and every cluster."""
    return records.withColumn("digest", F.md5(F.concat(key, F.lit(f"|{seed}")))).orderBy("digest", key).limit(n).drop("digest")


def validation_split(records: DataFrame, share: float = 0.2, seed: int = 42, key: str = "s1_id") -> DataFrame:
    """Records with ``is_val``, true for about ``share`` of them."""
    return records.withColumn("is_val", by_digest(F.col(key), seed) < share)


def training_pairs(pairs: DataFrame, truth: DataFrame, negatives: float = 10.0, seed: int = 42, add_true: bool = True) -> DataFrame:
    """``(s1_id, cand_id, label)`` of labelled records: candidates, true pairs if ``add_true``, and for each record
    at most ``int(positives * negatives)`` others, or 5 where it has no positive."""
    wanted = truth.select("s1_id", F.explode("targets").alias("cand_id")).distinct()
    mine = pairs.select("s1_id", "cand_id").join(truth.select("s1_id"), "s1_id", "left_semi")
    every = (mine.union(wanted) if add_true else mine).distinct()
    rows = every.join(wanted.withColumn("label", F.lit(1)), ["s1_id", "cand_id"], "left").na.fill(0, ["label"])
    positives = F.sum("label").over(Window.partitionBy("s1_id"))
    order = Window.partitionBy("s1_id", "label").orderBy(F.md5(F.concat("s1_id", "cand_id", F.lit(f"|{seed}"))), "cand_id")
    rows = rows.withColumns({"positives": positives, "at": F.row_number().over(order)})
    most = F.when(F.col("positives") > 0, F.floor(F.col("positives") * negatives)).otherwise(5)
    return rows.filter((F.col("label") == 1) | (F.col("at") <= most)).select("s1_id", "cand_id", "label")


def class_balance(labelled: DataFrame) -> DataFrame:
    counts = labelled.agg(F.count_if(F.col("label") == 1).alias("positives"), F.count_if(F.col("label") == 0).alias("negatives"))
    return counts.withColumn("positive_weight", F.col("negatives") / F.greatest(F.col("positives"), F.lit(1)))


def averaged_over_seeds(scored: DataFrame, truth: DataFrame, threshold: float, seeds: tuple[int, ...] = (42, 43, 44), score: str = "score") -> DataFrame:
    """``(seed, records, macro_f05)``: macro F0.5 on the validation records of each seed's split, and their mean under ``mean``."""
    rows = record_scores(assign(scored, threshold, score), truth)
    each = rows.withColumn("seed", F.explode(F.array(*(F.when(by_digest(F.col("s1_id"), s) < 0.2, F.lit(str(s))) for s in seeds)))).filter("seed is not null")
    by_seed = each.groupBy("seed").agg(F.count("*").alias("records"), F.avg("f05").alias("macro_f05"))
    return by_seed.unionByName(by_seed.agg(F.lit("mean").alias("seed"), F.sum("records").alias("records"), F.avg("macro_f05").alias("macro_f05")))
