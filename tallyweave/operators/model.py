"""An ensemble of tree and linear models over pair features."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.classification import GBTClassifier, RandomForestClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.operators.decide import best_threshold
from tallyweave.operators.features import FEATURES
from tallyweave.plans.durable import cut

#: Shares of the members in the blended probability.
BLEND = (0.4, 0.4, 0.2)
#: Subsets of features for members that see only names or only addresses.
NAME_FEATURES = tuple(c for c in FEATURES if c.startswith(("name_", "core_")) or c in ("suffix_match", "suffix_mismatch", "translit_sim"))
ADDRESS_FEATURES = tuple(c for c in FEATURES if c.startswith(("addr_", "pincode_", "street_")) or c in ("both_has_pincode", "one_missing_pincode", "country_match"))


def features_present(df: DataFrame) -> list[str]:
    return [c for c in FEATURES if c in df.columns]


@dataclass
class PairEnsemble:
    """Two boosted forests and a random forest, blended by :data:`BLEND`.

    Positives carry the weight of all negatives, each pair times its ``pair_weight``
    if there is one. ``fit`` takes a matrix with ``label`` and, to stop early, the
    boolean ``is_val``. A member that can't be
    trained (one class only) is left out and the blend renormalized; without
    members, scoring fails.
    """

    trees: int = 40
    depth: int = 5
    step: float = 0.1
    seed: int = 42
    subsets: tuple[tuple[str, ...], ...] | None = None
    members: list[tuple[float, PipelineModel]] = field(default_factory=list)

    def _stages(self, stops: bool) -> list:
        boosted = dict(labelCol="label", featuresCol="features", weightCol="weight", maxDepth=self.depth, stepSize=self.step, subsamplingRate=0.8, maxIter=self.trees)
        if stops:
            boosted["validationIndicatorCol"] = "is_val"
        return [
            GBTClassifier(seed=self.seed, featureSubsetStrategy="0.8", **boosted),
            GBTClassifier(seed=self.seed + 1, featureSubsetStrategy="onethird", maxBins=128, **boosted),
            RandomForestClassifier(labelCol="label", featuresCol="features", weightCol="weight", numTrees=self.trees, maxDepth=self.depth + 2, seed=self.seed + 2),
        ]

    def fit(self, matrix: DataFrame) -> PairEnsemble:
        held = F.coalesce(F.col("is_val"), F.lit(False)) if "is_val" in matrix.columns else F.lit(False)
        counts = matrix.agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n"), F.count_if(held).alias("held"), F.count_if(~held).alias("rest")).first()
        own = F.coalesce("pair_weight", F.lit(1.0)) if "pair_weight" in matrix.columns else F.lit(1.0)
        weighted = matrix.withColumn("weight", own * F.when(F.col("label") == 1, counts.n / max(counts.p, 1)).otherwise(1.0)).withColumn("label", F.col("label").cast("double"))
        columns = features_present(matrix)
        # Without rows on either side there is nothing to stop by.
        stages = self._stages(counts.held > 0 and counts.rest > 0)
        self.members = []
        if counts.p and counts.n:
            for k, (share, stage) in enumerate(zip(BLEND, stages, strict=True)):
                subset = [c for c in (self.subsets[k] if self.subsets else columns) if c in columns]
                self.members.append((share, Pipeline(stages=[VectorAssembler(inputCols=subset, outputCol="features"), stage]).fit(weighted)))
        return self

    def score(self, matrix: DataFrame, name: str = "proba") -> DataFrame:
        if not self.members:
            raise ValueError("no trained member")
        total = sum(share for share, _ in self.members)
        df = matrix.withColumn(name, F.lit(0.0))
        seen = None
        for share, model in self.members:
            assembler, trees = model.stages
            # Members that see the same columns share one vector.
            if assembler.getInputCols() != seen:
                df, seen = assembler.transform(df.drop("features")), assembler.getInputCols()
            df = trees.transform(df).withColumn(name, F.col(name) + vector_to_array("probability")[1] * (share / total)).drop("rawPrediction", "probability", "prediction")
        return df.drop("features")


def name_address_ensemble(**options) -> PairEnsemble:
    """Members that see names, addresses and everything."""
    return PairEnsemble(subsets=(NAME_FEATURES, ADDRESS_FEATURES, FEATURES), **options)


def calibrated(validation: DataFrame, scored: DataFrame, name: str = "proba") -> DataFrame:
    """``<name>_calibrated``: isotonic fit of labels on the scores of the validation pairs."""
    model = IsotonicRegression(featuresCol=name, labelCol="label", predictionCol=f"{name}_calibrated").fit(validation.select(name, F.col("label").cast("double").alias("label")))
    return model.transform(scored)


#: Probabilities from which a pair of an unlabelled record is taken for a match or for none, and the weight of such a pair.
SURE, UNSURE, PSEUDO_WEIGHT = 0.95, 0.05, 0.5


def pseudo_labelled(labelled: DataFrame, scored: DataFrame, sure: float = SURE, unsure: float = UNSURE, weight: float = PSEUDO_WEIGHT) -> DataFrame:
    """Labelled pairs with weight 1 and confidently scored pairs of other records with their own label and a smaller weight."""
    fresh = scored.filter((F.col("proba") >= sure) | (F.col("proba") <= unsure)).join(labelled.select("s1_id").distinct(), "s1_id", "left_anti")
    own = fresh.withColumns({"label": (F.col("proba") >= sure).cast("int"), "pair_weight": F.lit(weight), "is_val": F.lit(False)}).drop("proba")
    return labelled.withColumn("pair_weight", F.lit(1.0)).unionByName(own, allowMissingColumns=True)


def validation_score(ensemble: PairEnsemble, labelled: DataFrame) -> float:
    """Mean F0.5 of the best threshold on the validation pairs, whose labels are the truth."""
    rows = cut(ensemble.score(labelled.filter("is_val")).select("s1_id", "cand_id", "label", F.col("proba").alias("score")), "validation")
    truth = rows.groupBy("s1_id").agg(F.collect_list(F.when(F.col("label") == 1, F.col("cand_id"))).alias("targets"))
    best = best_threshold(rows, truth).first()
    return best.macro_f05 if best else 0.0


def pseudo_label_rounds(labelled: DataFrame, pool: DataFrame, rounds: int = 2, **options) -> tuple[PairEnsemble, list[float]]:
    """The ensemble after at most ``rounds`` of learning from its own sure pairs of ``pool``, and the validation scores.

    A round is kept only if the score on the labelled validation pairs does not fall; the first that lowers it ends the loop.
    """
    best = PairEnsemble(**options).fit(labelled)
    scores = [validation_score(best, labelled)]
    for _ in range(rounds):
        more = cut(pseudo_labelled(labelled, best.score(pool)), "pseudo")
        fresh = PairEnsemble(**options).fit(more)
        scores.append(validation_score(fresh, labelled))
        if scores[-1] < scores[-2]:
            break
        best = fresh
    return best, scores


def hard_negatives(scored: DataFrame, n: int = 5, score: str = "proba") -> DataFrame:
    """The ``n`` best-scored wrong pairs of each record."""
    from pyspark.sql.window import Window

    order = Window.partitionBy("s1_id").orderBy(F.desc(score), "cand_id")
    return scored.filter("label = 0").withColumn("at", F.row_number().over(order)).filter(F.col("at") <= n).drop("at")


def leave_one_country_out(matrix: DataFrame, country: str = "country_key", **options) -> DataFrame:
    """All pairs with the probability of an ensemble that never saw their country, and that country as ``held_out``.

    One ensemble for each country of the labelled pairs; countries for which no
    other has both classes are left out, as nothing can be learnt for them.
    """
    counts = matrix.groupBy(country).agg(F.count_if(F.col("label") == 1).alias("p"), F.count_if(F.col("label") == 0).alias("n")).orderBy(country).collect()
    positives, negatives = sum(r.p for r in counts), sum(r.n for r in counts)
    out = None
    for r in counts:
        if positives > r.p and negatives > r.n:
            mine = PairEnsemble(**options).fit(matrix.filter(F.col(country) != r[0])).score(matrix.filter(F.col(country) == r[0])).withColumn("held_out", F.lit(r[0]))
            out = mine if out is None else out.unionByName(mine)
    return out if out is not None else matrix.limit(0).withColumns({"proba": F.lit(0.0), "held_out": F.col(country)})
