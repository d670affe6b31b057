"""The N best items of every group by descending score bands."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyweave.plans.durable import cut

#: Shares of the scored rows that lie above the lower edge of each band.
BANDS = (0.12, 0.35, 0.65, 1.0)


def scored_items(pairs: DataFrame) -> DataFrame:
    """Exploded ``(grp, item, score)``: Source 2 and 3 ids with a score that is a number."""
    listed = pairs.filter("source1_entity_id is not null and candidate_entity_ids is not null and candidate_scores is not null").select(
        F.col("source1_entity_id").alias("grp"), F.explode(F.arrays_zip(F.split("candidate_entity_ids", ",").alias("i"), F.col("candidate_scores").alias("s"))).alias("x")
    )
    rows = listed.select("grp", F.trim(F.regexp_replace(F.col("x.i"), r"^[\s ]+|[\s ]+$", "")).alias("item"), F.col("x.s").alias("score"))
    return rows.filter((F.col("item").startswith("S2-") | F.col("item").startswith("S3-")) & F.col("score").isNotNull() & ~F.isnan("score"))


def top_n(items: DataFrame, n: int = 10, bands: tuple[float, ...] = BANDS) -> DataFrame:
    """``(grp, item, score, rank)``: each group's ``n`` best distinct items.

    ``items`` has ``grp``, ``item`` and ``score``, none null. An item's score is
    its highest; equal scores are ordered by smaller item. Groups with fewer
    items keep all; an empty input gives an empty result.

    The rows are written once, partitioned into score bands. From the top band
    down, rows of groups that are already full are anti-joined away before they
    are shuffled; the others are reduced to distinct items, and groups that reach
    ``n`` leave. Only a group's last band is ranked exactly, with the first ``n``
    picked on the map side, so a group of any size never meets in one task.
    """
    spark = items.sparkSession
    edges = items.agg(F.percentile_approx("score", [1 - b for b in bands[:-1]], 10_000)).first()[0] or []
    edges = sorted(set(edges), reverse=True)
    band = F.lit(len(edges))
    for k in range(len(edges) - 1, -1, -1):
        band = F.when(F.col("score") >= edges[k], k).otherwise(band)
    banded = cut(items.select("grp", "item", "score", band.alias("band")), "bands", ["band"])

    best_first = Window.partitionBy("grp").orderBy(F.desc("score"), "item")
    ranked = lambda d: d.withColumn("rank", F.row_number().over(best_first)).filter(F.col("rank") <= n)
    done: list[DataFrame] = []
    held: DataFrame | None = None
    full: DataFrame | None = None
    for k in range(len(edges) + 1):
        rows = banded.filter(F.col("band") == k).select("grp", "item", "score")
        if full is not None:
            rows = rows.join(full, "grp", "left_anti")
        if held is not None:
            rows = rows.unionByName(held)
        state = rows.groupBy("grp", "item").agg(F.max("score").alias("score"))
        if k == len(edges):
            done.append(ranked(state))
            break
        # Distinct items so far: those of this band and what the group brought along.
        state = cut(state, f"band{k}")
        now_full = state.groupBy("grp").count().filter(F.col("count") >= n).select("grp")
        done.append(ranked(state.join(now_full, "grp", "left_semi")))
        held = state.join(now_full, "grp", "left_anti")
        full = now_full if full is None else full.unionByName(now_full)
    out = done[0]
    for more in done[1:]:
        out = out.unionByName(more)
    return out if edges else ranked(spark.createDataFrame([], items.select("grp", "item", "score").schema))
