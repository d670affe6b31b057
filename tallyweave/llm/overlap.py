"""Records of evaluation splits that also stand in the training split."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyweave.llm import records
from tallyweave.llm.arrow import map_rows
from tallyweave.llm.linkage import whole_keys
from tallyweave.plans.durable import cut

#: Least part of the shorter of two texts that matched passages must cover.
COVERAGE = 0.3
#: Evaluation texts of a shard at most, about; an automaton holds their passages.
SHARD_TEXTS = 20_000
#: Training texts of a hot key that one task scans, about.
SHARD_READS = 100_000


def normal_text(n: str, a: str) -> str:
    """Normalised text of a record: the parts of its codes between single blanks."""
    name, place = n.split("|"), a.split("|")
    parts = [name[0], f"t{name[1]}" if len(name) > 1 and name[1] else "", f"#{name[2]}" if len(name) > 2 and name[2] else ""]
    if len(place) > 3:
        parts += [place[0], place[1], place[2], place[3]]
    return " " + " ".join(p for p in parts if p) + " "


def passages(n: str, a: str) -> tuple[list[str], list[str]]:
    """Passages of an evaluation record, anchors first: its words, neighbouring words of name and street, house
    with street; then those that only add to a coverage: town, postcode and trade."""
    name, place = n.split("|"), a.split("|")
    own, street = name[0].split(), place[1].split() if len(place) > 1 else []
    anchors = [f" {w} " for w in (*own, *street) if len(w) > 2]
    anchors += [f" {x} {y} " for x, y in (*zip(own, own[1:]), *zip(street, street[1:]))]
    if len(place) > 3 and place[0] and street:
        anchors.append(f" {place[0]} {street[0]} ")
    more = [f" {w} " for w in place[2:4] if len(w) > 2]
    if len(name) > 1 and name[1]:
        more.append(f" t{name[1]} ")
    anchors = list(dict.fromkeys(anchors))
    return anchors, [p for p in dict.fromkeys(more) if p not in anchors]


class Scanner:
    """Aho-Corasick automaton over the passages of evaluation records."""

    def __init__(self, texts: list[tuple[str, str, str]]):
        import ahocorasick

        self.texts = texts
        self.automaton = ahocorasick.Automaton()
        self.of: list[set[str]] = []
        self.sizes: list[int] = []
        self.postings: dict[str, list[int]] = {}
        every: set[str] = set()
        for k, (_, n, a) in enumerate(texts):
            anchors, more = passages(n, a)
            self.of.append({*anchors, *more})
            self.sizes.append(len(normal_text(n, a)))
            every |= self.of[-1]
            for p in anchors:
                self.postings.setdefault(p, []).append(k)
        for p in every:
            self.automaton.add_word(p, p)
        if every:
            self.automaton.make_automaton()
        self.house = np.array([a.partition("|")[0] for _, _, a in texts], dtype=object)
        self.anchored = {p: np.array(own) for p, own in self.postings.items()}

    def scan(self, text: str, house: str = "") -> Iterator[tuple[int, float]]:
        """Evaluation texts whose passages cover enough of ``text`` or of themselves.

        Every text of a matched anchor is proposed, however common the anchor; texts
        of another ``house`` than the one given contradict it and are left out.
        """
        found: dict[str, list[tuple[int, int]]] = {}
        for end, p in self.automaton.iter(text):
            found.setdefault(p, []).append((end - len(p) + 1, end + 1))
        own = [self.anchored[p] for p in found if p in self.anchored]
        if not own:
            return
        proposed = np.unique(np.concatenate(own))
        if house:
            theirs = self.house[proposed]
            proposed = proposed[(theirs == house) | (theirs == "")]
        for k in proposed.tolist():
            spans = sorted(s for p in found.keys() & self.of[k] for s in found[p])
            covered = at = 0
            for low, high in spans:
                covered += max(0, high - max(low, at))
                at = max(at, high)
            share = covered / min(len(text), self.sizes[k])
            if share >= COVERAGE:
                yield k, share


def same_record(n1: str, a1: str, n2: str, a2: str) -> bool:
    """Whether two parsed records are one record up to small differences of writing."""
    name, place = records.name_cost(n1, n2), records.address_evidence(a1, a2)
    if place is not None and place[0] < 0 or name is not None and name >= 1.3:
        return False
    if name is None:
        return not n1 and not n2 and place is not None and place[0] >= 2.6
    if place is None:
        return not a1 and not a2 and name < 0.6
    return place[0] >= 1.4 and (name < 0.8 or place[0] >= 2.5)


def overlaps(parsed_rows: DataFrame, splits: dict[str, tuple[str, str]]) -> DataFrame:
    """``(split, train_id, eval_id, coverage)`` for ``splits`` name -> (training table, evaluation table).

    Equal parsed records are scanned once, and those equal on both sides of a split are
    joined directly. Evaluation texts are sharded by their
    anchors (words of name and street, hot ones as in :func:`whole_keys`); every training
    text goes to the shards of its own anchors and is scanned there against the
    automaton of all their passages; matched intervals are merged into a coverage
    per evaluation record, and pairs that reach the least coverage are checked
    exactly. Records without name and address are nobody's copy.
    """
    side = lambda k: F.coalesce(*(F.when(F.col("src") == s[k], name) for name, s in splits.items()))
    rows = parsed_rows.withColumn("train", side(0)).withColumn("test", side(1)).filter("(train is not null or test is not null) and (n <> '' or a <> '')")
    rows = rows.select("id", "n", "a", F.coalesce("train", "test").alias("split"), F.col("test").isNotNull().alias("evaluated"))
    texts = cut(rows.groupBy("split", "evaluated", "n", "a").agg(F.min("id").alias("rep")), "texts")

    def keyed(split, evaluated, codes, places, reps):
        for s, e, n, a, rep in zip(split, evaluated, codes, places, reps, strict=True):
            own = records.name_keys(n, outer=False) + records.address_keys(a, bare=True)
            yield rep, e, [k ^ hash_of[s] for k in dict.fromkeys(own)], a.partition("|")[0] if a else None

    hash_of = {s: k * 0x9E3779B97F4A7C15 % (1 << 63) for k, s in enumerate(splits)}
    keys = cut(map_rows(texts.select("split", "evaluated", "n", "a", "rep"), keyed, "id string, evaluated boolean, keys array<bigint>, house string"), "anchors")
    left, right = whole_keys(keys.filter("evaluated"), keys.filter("not evaluated"), texts=SHARD_TEXTS, reads=SHARD_READS)
    both = left.select("key", F.col("id").alias("rep"), F.lit(True).alias("evaluated")).unionByName(right.select("key", F.col("id").alias("rep"), F.lit(False).alias("evaluated")))
    # Anchors of one side only lead nowhere.
    met = both.groupBy("key").agg(F.min("evaluated").alias("low"), F.max("evaluated").alias("high")).filter("low <> high").select("key")
    n_eval = texts.filter("evaluated").count()
    shards = max(16, -(-4 * n_eval // SHARD_TEXTS))
    routed = both.join(met, "key").select(F.pmod("key", F.lit(shards)).alias("shard"), "evaluated", "rep").distinct().join(texts, ["rep", "evaluated"])

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        current, waiting, scanner = None, [], None
        for batch in batches:
            out = []
            for split, shard, evaluated, rep, n, a in batch[["split", "shard", "evaluated", "rep", "n", "a"]].itertuples(index=False):
                if (split, shard) != current:
                    current, waiting, scanner = (split, shard), [], None
                if evaluated:
                    waiting.append((rep, n, a))
                    continue
                if scanner is None:
                    scanner = Scanner(waiting)
                if waiting:
                    for k, share in scanner.scan(normal_text(n, a), a.partition("|")[0]):
                        other, n2, a2 = waiting[k]
                        if same_record(n, a, n2, a2):
                            out.append((split, rep, other, share))
            yield pd.DataFrame(out, columns=["split", "train_rep", "eval_rep", "coverage"])

    # Within a shard the evaluation texts come first.
    placed = routed.repartition("split", "shard").sortWithinPartitions("split", "shard", F.desc("evaluated"))
    found = placed.mapInPandas(scan, "split string, train_rep string, eval_rep string, coverage double")

    def copied(split, trained, tested, codes, places):
        for s, x, y, n, a in zip(split, trained, tested, codes, places, strict=True):
            if same_record(n, a, n, a):
                yield s, x, y, 1.0

    of_side = lambda evaluated, rep: texts.filter(F.col("evaluated") == evaluated).select("split", "n", "a", F.col("rep").alias(rep))
    equal = of_side(False, "train_rep").join(of_side(True, "eval_rep"), ["split", "n", "a"]).select("split", "train_rep", "eval_rep", "n", "a")
    found = found.unionByName(map_rows(equal, copied, "split string, train_rep string, eval_rep string, coverage double"))
    found = found.groupBy("split", "train_rep", "eval_rep").agg(F.max("coverage").alias("coverage"))

    members = rows.join(texts, ["split", "evaluated", "n", "a"]).select("split", "evaluated", "rep", "id")
    of = lambda evaluated, rep, to: members.filter(F.col("evaluated") == evaluated).select("split", F.col("rep").alias(rep), F.col("id").alias(to))
    return found.join(of(False, "train_rep", "train_id"), ["split", "train_rep"]).join(of(True, "eval_rep", "eval_id"), ["split", "eval_rep"]).select("split", "train_id", "eval_id", "coverage")


def overlap_counts(pairs: DataFrame, splits: dict[str, tuple[str, str]]) -> DataFrame:
    """``(split, train_source, eval_source, pairs, train_records, eval_records)``, zeros included."""
    spark = pairs.sparkSession
    names = spark.createDataFrame([(k, *v) for k, v in splits.items()], "split string, train_source string, eval_source string")
    counted = pairs.groupBy("split").agg(F.count("*").alias("pairs"), F.countDistinct("train_id").alias("train_records"), F.countDistinct("eval_id").alias("eval_records"))
    return names.join(counted, "split", "left").na.fill(0)
