import itertools
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyweave.functions.text import normalized
from tallyweave.operators import blocking, cluster, decide, features, idf, model, retrieval
from tallyweave.operators.countries import country_keys, with_country_keys

RECORD = "entity_id string, business_name string, business_address string, country string"


def records(spark, rows):
    return with_country_keys(normalized(spark.createDataFrame(rows, RECORD)))[0]


def two_sides(spark, n=120):
    left = [(f"S1-{k:09d}", f"acme {k % 7} works {'x' * (k % 3)}", f"{k} main st 56000{k % 10}", "IN") for k in range(n // 4)]
    right = [(f"S2-{k:09d}", f"acme {k % 7} works", f"{k} main st 56000{k % 10}", "IN") for k in range(n)]
    return records(spark, left), records(spark, right)


def test_capped_blocks(spark):
    left, right = two_sides(spark)
    full = {(r.s1_id, r.cand_id, r.key_type, r.key) for r in blocking.capped_candidates(left, right, per_key=10_000).collect()}
    keys = lambda d, right: {(r.entity_id, r.key_type, r.key) for r in blocking.block_keys(d, right).collect()}
    brute = {(a, b, t, k) for (a, t, k), (b, t2, k2) in itertools.product(keys(left, False), keys(right, True)) if (t, k) == (t2, k2)}
    assert full == brute
    assert {tuple(r) for r in blocking.capped_candidates(left, right, per_key=None).collect()} == brute
    capped = [tuple(r) for r in blocking.capped_candidates(left, right, per_key=5).collect()]
    assert len(capped) == len(set(capped)) and set(capped) <= full
    per = {}
    for s, _, t, k in capped:
        per[s, t, k] = per.get((s, t, k), 0) + 1
    sizes = {}
    for s, _, t, k in full:
        sizes[s, t, k] = sizes.get((s, t, k), 0) + 1
    assert per == {x: min(5, n) for x, n in sizes.items()}


def test_record_cap_and_empty(spark):
    left, right = two_sides(spark)
    rows = blocking.rule_candidates(left, right, per_record=3).groupBy("s1_id").count().collect()
    assert all(r["count"] == 3 for r in rows)
    assert blocking.rule_candidates(left.limit(0), right).count() == 0
    assert blocking.rule_candidates(left, right.limit(0)).count() == 0


def test_tfidf_against_brute_force(spark):
    left, right = two_sides(spark, 60)
    text = F.col("name_norm")
    got = {(r.s1_id, r.cand_id): r.score for r in retrieval.tfidf_candidates(left, right, text, k=1000, max_postings=None).collect()}
    import math
    from collections import Counter

    rows = [(r.entity_id, r.name_norm) for r in left.union(right).collect()]

    def grams(t, kind):
        if kind == "word":
            w = [x for x in t.split() if len(x) > 1]
            return w + [f"{a} {b}" for a, b in zip(w, w[1:])]
        return [p[i : i + n] for n in (2, 3) for w in t.split() for p in [f" {w} "] for i in range(max(1, len(p) - n + 1))]

    total = Counter()
    for kind in ("char", "word"):
        tf = {i: Counter(grams(t, kind)) for i, t in rows}
        df = Counter(g for c in tf.values() for g in c)
        w = {i: {g: (1 + math.log(n)) * (math.log((1 + len(rows)) / (1 + df[g])) + 1) for g, n in c.items()} for i, c in tf.items()}
        norm = {i: math.sqrt(sum(x * x for x in v.values())) for i, v in w.items()}
        for a, b in itertools.product([i for i, _ in rows if i[1] == "1"], [i for i, _ in rows if i[1] == "2"]):
            if norm[a] and norm[b]:
                total[a, b] += sum(x * w[b].get(g, 0) for g, x in w[a].items()) / norm[a] / norm[b]
    want = {k: v for k, v in total.items() if v > 0}
    assert got.keys() == want.keys()
    assert all(got[k] == pytest.approx(v, abs=1e-6) for k, v in want.items())


def test_assignment_equals_greedy(spark):
    rng = random.Random(5)
    pairs = [(f"s{a}", f"c{b}", round(rng.random(), 6)) for a in range(15) for b in range(20) if rng.random() < 0.5]
    taken, want = set(), set()
    for s, c, p in sorted(pairs, key=lambda x: (-x[2], x[0])):
        if p >= 0.3 and c not in taken:
            taken.add(c)
            want.add((s, c))
    df = spark.createDataFrame(pairs, "s1_id string, cand_id string, score double")
    assert {(r.s1_id, r.cand_id) for r in decide.assign(df, 0.3).collect()} == want


def test_f_half_and_curve(spark):
    truth = spark.createDataFrame([("a", ["1", "3"]), ("b", []), ("c", ["5"])], "s1_id string, targets array<string>")
    scored = spark.createDataFrame([("a", "1", 0.9), ("a", "2", 0.9), ("a", "3", 0.9), ("b", "4", 0.3), ("z", "9", 0.99)], "s1_id string, cand_id string, score double")
    rows = {r.s1_id: r.f05 for r in decide.record_scores(scored.filter("score >= 0.5"), truth).collect()}
    assert rows == {"a": pytest.approx(0.7142857), "b": 1.0, "c": 0.0}
    curve = {round(r.threshold, 2): r.macro_f05 for r in decide.threshold_curve(scored, truth).collect()}
    assert len(curve) == 71
    assert curve[0.25] == pytest.approx(0.7142857 / 3) and curve[0.3] == pytest.approx(0.7142857 / 3) and curve[0.5] == pytest.approx(1.7142857 / 3)
    best = decide.best_threshold(scored, truth).first()
    assert best.threshold == pytest.approx(0.31)
    assert decide.macro_f_half(scored, truth.limit(0)).first()[0] == 0.0


def test_components(spark):
    rng = random.Random(3)
    links = [(f"n{rng.randrange(200):03d}", f"n{rng.randrange(200):03d}") for _ in range(140)] + [("p1", "p2"), ("q", "q"), (None, "q")] + [(f"c{k:03d}", f"c{k + 1:03d}") for k in range(60)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a and b:
            x, y = find(a), find(b)
            parent[max(x, y)] = min(x, y)
    df = spark.createDataFrame(links, "a string, b string")
    got = {r.node: r.component for r in cluster.components(df).collect()}
    assert got == {x: find(x) for x in parent}


def test_label_clusters(spark):
    df = spark.createDataFrame([("India",)] * 5 + [("INDIA",)] * 2 + [("Indai",), ("Indi",), ("US",), ("U.S.",), ("us",), ("UK",), (None,), (" ",)], "country string")
    got = {r.label: r.cluster for r in cluster.label_clusters(df, "country").collect()}
    assert got["INDIA"] == got["India"] == got["Indi"] == "India"
    assert got["US"] == got["U.S."] == got["us"] and got["UK"] == "UK"


def test_feature_matrix(spark):
    left, right = two_sides(spark, 40)
    pairs = blocking.rule_candidates(left, right).union(spark.createDataFrame([("S1-unknown", "S2-unknown")], "s1_id string, cand_id string"))
    weights = idf.fit(left.select("name_norm").union(right.select("name_norm")), "name_norm")
    out = features.feature_matrix(pairs, left, right, weights)
    assert set(features.FEATURES) <= set(out.columns) and len(features.FEATURES) == 44
    rows = out.collect()
    assert len(rows) == pairs.count() - 1
    for r in rows:
        assert all(r[c] is not None for c in features.FEATURES)
        assert r.core_sort == r.core_sorted_sim and 1 <= r.cand_rank <= r.cand_count_for_s1
    assert features.feature_matrix(pairs.limit(0), left, right, weights).count() == 0


def test_training_pairs(spark):
    truth = spark.createDataFrame([("a", ["1"]), ("b", [])], "s1_id string, targets array<string>")
    pairs = spark.createDataFrame([(s, str(k)) for s in "abz" for k in range(30)], "s1_id string, cand_id string")
    rows = decide.training_pairs(pairs, truth, 3.0).collect()
    count = lambda s, y: sum(r.s1_id == s and r.label == y for r in rows)
    assert (count("a", 1), count("a", 0), count("b", 1), count("b", 0), count("z", 0)) == (1, 3, 0, 5, 0)


def test_cosine_neighbours(spark):
    rng = random.Random(1)
    rows = [(k, [rng.gauss(0, 1) for _ in range(8)]) for k in range(80)] + [(80, [0.0] * 8), (81, None)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<float>")
    got = {(r.query_id, r["rank"]): r.vec_id for r in retrieval.cosine_neighbours(df, df.filter("vec_id % 20 = 0"), 3, block=2).collect()}
    import numpy as np

    m = np.array([v for _, v in rows[:80]], dtype="float32").astype(float)
    m /= np.linalg.norm(m, axis=1, keepdims=True)
    for q in (0, 20, 40, 60):
        order = [k for k in np.argsort(-(m @ m[q])) if k != q][:3]
        assert [got[q, r] for r in (1, 2, 3)] == order


def test_further_keys_and_flags(spark):
    from tallyweave.operators import quality

    left = records(spark, [("S1-1", "Kapur Textiles Ltd", "1 Main St Oregon", "US"), ("S1-2", "", "", "US"), ("S1-3", "12345 lane", "nowhere", "US")])
    right = records(spark, [("S2-1", "Textiles Capur", "9 Side St Oregon", "US"), ("S2-2", "Kapoor Textile", "Elsewhere", "US"), ("S2-3", "a\x01b ltd", "1 x or", "US")])
    sound = {(r.s1_id, r.cand_id) for r in blocking.keyed_candidates(left, right, blocking.sound_key(F.col("name_core"))).collect()}
    assert sound == {("S1-1", "S2-2")}
    place = {(r.s1_id, r.cand_id) for r in blocking.keyed_candidates(left, right, blocking.place_key(F.col("address_norm"))).collect()}
    assert place == {("S1-1", "S2-1")}
    flags = {r.entity_id: r for r in quality.record_flags(left.union(right)).collect()}
    assert flags["S1-3"].fields_swapped == 1 and flags["S2-3"].has_control == 1 and flags["S2-3"].has_state == 1 and flags["S1-2"].low_information == 1
    lines = spark.createDataFrame([("a\tb\tc\td",), ("a\tb",)], "value string")
    good, bad = quality.quarantine(lines)
    assert good.count() == bad.count() == 1


def test_retrieval_matches_terms_of_many_records(spark):
    right = records(spark, [(f"S2-{k:09d}", "acme", "", "IN") for k in range(450)])
    left = records(spark, [("S1-000000001", "acme", "", "IN")])
    for find in (retrieval.tfidf_candidates, retrieval.bm25_candidates):
        got = [r.cand_id for r in find(left, right, F.col("name_norm")).orderBy("rank").collect()]
        assert got == [f"S2-{k:09d}" for k in range(20)]


def test_top_by_terms_against_a_join(spark):
    rng = random.Random(5)
    rows = [("IN", side, f"S{side}-{k:03d}", f"t{t}", float(rng.randint(1, 4))) for side, n in ((1, 40), (2, 90)) for k in range(n) for t in {min(int(rng.expovariate(0.3)), 30) for _ in range(5)}]
    weights = spark.createDataFrame(rows, "country string, side int, entity_id string, term string, w double")
    sums = {}
    for (_, s, a, t, u), (_, s2, b, t2, v) in itertools.product(rows, rows):
        if (s, s2, t) == (1, 2, t2):
            sums[a, b] = sums.get((a, b), 0.0) + u * v
    ranked = {a: sorted((-x, b) for (l, b), x in sums.items() if l == a)[:7] for a in {a for a, _ in sums}}
    got = {(r.s1_id, r["rank"]): (-r.score, r.cand_id) for r in retrieval.top_by_terms(weights, 7, left_block=15, right_block=20).collect()}
    assert got == {(a, k + 1): x for a, best in ranked.items() for k, x in enumerate(best)}


def test_country_keys(spark):
    rows = [("US",)] * 5 + [("USA",), ("U.S.",), ("India",), ("INDIA",), ("IN",), ("FR",), ("France",), ("Chad",), ("China",), ("CH",), (None,), ("",), ("N/A",)]
    labels = spark.createDataFrame(rows, "country_norm string")
    got = {r.label: r.country_key for r in country_keys(labels).collect()}
    assert got["US"] == got["USA"] == got["U.S."] == "usa" and got["IN"] == got["INDIA"] == "india" and got["FR"] == "france"
    assert got["CH"] == "ch" and got["Chad"] == "chad" and got[None] == got[""] == got["N/A"] == ""


def test_records_without_country_meet_all(spark):
    rows = lambda side: [(f"{side}-{c or 'none'}", "acme works", "", c) for c in ("US", "usa", "India", "")]
    left, right = with_country_keys(*(normalized(spark.createDataFrame(rows(s), RECORD)) for s in ("S1", "S2")))
    got = {(r.s1_id[3:], r.cand_id[3:]) for r in blocking.rule_candidates(left, right, None, None).collect()}
    one = lambda c: "us" if c in ("US", "usa") else c
    every = ("US", "usa", "India", "none")
    assert got == {(a, b) for a in every for b in every if "none" in (a, b) or one(a) == one(b)}


def test_most_shared_keys_are_kept(spark):
    left = records(spark, [("S1-1", "acme textile works", "5 main st 560001", "IN")])
    right = records(spark, [(f"S2-{k:02d}", "acme other", "", "IN") for k in range(30)] + [("S2-99", "acme textile works", "5 main st 560001", "IN")])
    assert "S2-99" in {r.cand_id for r in blocking.rule_candidates(left, right, per_record=2).collect()}


def test_learning_operators(spark):
    rng = random.Random(7)
    rows = []
    for k in range(240):
        y = int(rng.random() < 0.4)
        rows.append((f"s{k % 60}", f"c{k}", y, k % 60 < 15, "ab"[k % 2], min(1.0, max(0.0, y * 0.7 + rng.random() * 0.3)), rng.random()))
    matrix = spark.createDataFrame(rows, "s1_id string, cand_id string, label int, is_val boolean, country_key string, name_lev double, addr_lev double")
    options = {"trees": 3, "depth": 2}
    held = model.leave_one_country_out(matrix, **options).collect()
    assert len(held) == len(rows) and all(r.held_out == r.country_key for r in held)
    assert model.leave_one_country_out(matrix.limit(0)).count() == 0
    pool = matrix.drop("label", "is_val").withColumns({"s1_id": F.concat(F.lit("u"), "s1_id"), "cand_id": F.concat(F.lit("u"), "cand_id")})
    ensemble, scores = model.pseudo_label_rounds(matrix, pool, **options)
    assert 2 <= len(scores) <= 3 and all(0 <= s <= 1 for s in scores) and ensemble.members
    full = model.PairEnsemble(**options).fit(matrix)
    more = model.pseudo_labelled(matrix, full.score(pool), sure=0.5, unsure=0.5)
    assert {r.pair_weight for r in more.select("pair_weight").distinct().collect()} == {0.5, 1.0}
    light = model.PairEnsemble(**options).fit(matrix.withColumn("pair_weight", F.when(F.col("label") == 1, 1e-6).otherwise(1.0)))
    top = lambda e: e.score(matrix).agg(F.avg("proba")).first()[0]
    assert top(light) < top(full)
    scored = full.score(matrix)
    calibrated = model.calibrated(scored, scored).orderBy("proba").collect()
    assert all(x.proba_calibrated <= y.proba_calibrated + 1e-9 for x, y in itertools.pairwise(calibrated))


def test_cluster_split_and_seeds(spark):
    truth = spark.createDataFrame([(f"a{k:02d}", [f"c{k // 2}", f"d{k}"]) for k in range(40)] + [("z", [])], "s1_id string, targets array<string>")
    rows = {r.s1_id: r for r in cluster.cluster_split(truth, 0.5).collect()}
    assert len(rows) == 41 and {r.is_val for r in rows.values()} == {True, False}
    assert all(rows[f"a{k:02d}"].is_val == rows[f"a{k + 1:02d}"].is_val for k in range(0, 40, 2))
    scored = spark.createDataFrame([(f"a{k:02d}", f"d{k}", 0.9) for k in range(40)], "s1_id string, cand_id string, score double")
    out = {r.seed: r for r in decide.averaged_over_seeds(scored, truth, 0.5).collect()}
    assert set(out) == {"42", "43", "44", "mean"} and out["mean"].records == sum(out[s].records for s in ("42", "43", "44"))


@pytest.mark.parametrize(("form", "per_key", "per_record", "whole"), [("S2-{:09d}", 7, 9, 40), ("{}x", 7, 9, 500_000), ("S{}-7", 75, None, 500_000)])
def test_candidates_as_codes(spark, form, per_key, per_record, whole):
    """F2, F3, F8, F9: candidates travel as codes in one row for each record and key; they are those of single pairs, in small blocks and large ones."""
    words = ("acme", "textile", "works", "royal", "bakery")
    rows = lambda n, ids: [(ids(k), " ".join((words[k % 5], words[k * 7 % 4], f"own{k % 11}")), f"{k} main{k % 3} st 56000{k % 10}", ("IN", "US", "")[k % 3]) for k in range(n)]
    sides = [normalized(spark.createDataFrame(r, RECORD)) for r in (rows(40, "S1-{:09d}".format), rows(150, form.format))]
    left, right = with_country_keys(*sides)
    pairs = blocking.capped_candidates(left, right, per_key=per_key).groupBy("s1_id", "cand_id").count()
    best = Window.partitionBy("s1_id").orderBy(F.desc("count"), F.md5(F.concat("s1_id", "cand_id")), "cand_id")
    want = {(r.s1_id, r.cand_id) for r in pairs.withColumn("at", F.row_number().over(best)).filter(F.col("at") <= (per_record or 10**6)).collect()}
    lists, codes = blocking.rule_codes(left, right, per_key, per_record, whole)
    got = [tuple(r) for r in lists.select("s1_id", F.explode("codes").alias("c")).select("s1_id", codes.back(F.col("c"))).collect()]
    assert len(got) == len(set(got)) and set(got) == want and lists.count() == 40
    if form == "S2-{:09d}":
        every = {tuple(r) for r in blocking.rule_candidates(left, right).collect()}
        assert blocking.rule_pairs(left, right).first().pairs == len(every)
        assert {(r.s1_id, x) for r in blocking.rule_lists(left, right).collect() for x in r.ids} == every


def test_recall_of_labelled_records_alone(spark):
    """F2: candidates of a record don't depend on other left records, so recall needs those of labelled ones only."""
    left, right = two_sides(spark, 60)
    truth = spark.createDataFrame([(f"S1-{k:09d}", [f"S2-{k:09d}", "S2-none"]) for k in range(5)], "s1_id string, targets array<string>")
    labelled = left.join(truth.select(F.col("s1_id").alias("entity_id")), "entity_id", "left_semi")
    some, every = (blocking.blocking_recall(blocking.rule_candidates(d, right), truth).first() for d in (labelled, left))
    assert some == every and some.captured == 5 and labelled.count() == 5


def test_packed_retrieval_against_columns_of_terms(spark):
    rng = random.Random(8)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 5))) for _ in range(40)]
    rows = [(f"S{side}-{k % 70:03d}", rng.choice(["usa", "usa", "india", ""]), " ".join(rng.choices(words, k=rng.randint(0, 6)))) for side, n in ((1, 80), (2, 100)) for k in range(n)]
    every = spark.createDataFrame(rows, "entity_id string, country_key string, t string")
    left, right = (every.filter(F.col("entity_id").startswith(s)) for s in ("S1", "S2"))
    sides = retrieval.both_sides(left, right, F.col("t"))
    weights = [retrieval.term_weights(sides, terms, cap).withColumn("term", F.concat(F.lit(tag), "term")) for tag, terms, cap in (("c", retrieval.char_wb_grams(F.col("text")), 60), ("w", retrieval.word_grams(F.col("text")), 30))]
    want = {tuple(r) for r in retrieval.top_by_terms(weights[0].unionByName(weights[1]), 4).select("s1_id", "rank", F.round("score", 7)).collect()}
    found = lambda **more: retrieval.tfidf_candidates(left, right, F.col("t"), 4, char_terms=60, word_terms=30, **more).select("s1_id", "rank", F.round("score", 7))
    assert {tuple(r) for r in found().collect()} == want
    some = spark.createDataFrame([("S1-003",), ("S1-011",)], "entity_id string")
    assert {tuple(r) for r in found(asked=some).collect()} == {x for x in want if x[0] in ("S1-003", "S1-011")} != set()


def test_retrieval_writes_little_more_than_texts(spark):
    from pathlib import Path

    from tallyweave.plans import durable

    rng = random.Random(9)
    words = ["".join(rng.choices("abcdefghijklmnop", k=7)) for _ in range(400)]
    rows = [(f"S{1 + k % 2}-{k:09d}", "usa", " ".join(rng.choices(words, k=9))) for k in range(6000)]
    every = spark.createDataFrame(rows, "entity_id string, country_key string, t string")
    before = len(durable._written)
    retrieval.tfidf_candidates(*(every.filter(F.col("entity_id").startswith(s)) for s in ("S1", "S2")), F.col("t"), 2).count()
    written = sum(f.stat().st_size for _, path in durable._written[before:] for f in Path(path.removeprefix("file://")).rglob("*.parquet"))
    assert written < 8 * sum(len(t) for _, _, t in rows)


def test_candidates_of_some_records_are_those_among_all(spark):
    from tallyweave.plans import pipeline

    left, right = two_sides(spark, 60)
    every = {tuple(r) for r in pipeline.candidates(left, right, 5).collect()}
    some = left.select("entity_id").orderBy("entity_id").limit(4)
    wanted = {r.entity_id for r in some.collect()}
    assert {tuple(r) for r in pipeline.candidates(left, right, 5, asked=some).collect()} == {x for x in every if x[0] in wanted} != set()


def test_rough_scores_keep_all_that_exact_ones_may_choose():
    """all pairs are scored in single precision with a known error, and only those that may be among the best once more in double."""
    import numpy as np

    rng = np.random.default_rng(4)
    terms = 300

    def postings(rows):
        at = rng.random((rows, terms)) < rng.random(terms) ** 4
        row, code = np.nonzero(at)
        return retrieval.Postings(rows, row, code, rng.random(len(row)) * 10.0 ** rng.integers(-3, 3, len(row)))

    def full(side):
        out = np.zeros((side.rows, terms))
        out[side.row, side.code] = side.w
        return out

    left, right = postings(70), postings(90)
    want = full(left) @ full(right).T
    rough, error = retrieval.rough_scores(left, right, terms), retrieval.rough_error(left)
    assert rough.dtype == np.float32 and ((rough > 0) == (want > 0)).all() and error < 1e-4
    assert (np.abs(rough - want) <= error * want).all()
    r, c = np.nonzero(rough >= 0)
    assert np.allclose(retrieval.pair_scores(left, right, terms, r, c), want[r, c], rtol=1e-12)


@pytest.mark.parametrize(("form", "per_record"), [("S2-{:09d}", 9), ("{}x", 9), ("S2-{:09d}", None)])
def test_further_candidates_join_those_of_rules(spark, form, per_record):
    """retrieved candidates are added to a record's rule candidates as codes in its task, not as shuffled pairs."""
    rows = lambda n, ids: records(spark, [(ids(k), f"acme {k % 7} works", f"{k} main st 56000{k % 10}", "IN") for k in range(n)])
    left, right = rows(20, "S1-{:09d}".format), rows(80, form.format)
    more = spark.createDataFrame([(f"S1-{k:09d}", form.format(k * j % 80)) for k in range(0, 20, 2) for j in range(1, 9)], "s1_id string, cand_id string").distinct()
    rules = blocking.rule_candidates(left, right, 7, per_record)
    want = {tuple(r) for r in rules.union(more).distinct().collect()}
    frame = blocking.rule_candidates(left, right, 7, per_record, more)
    got = [tuple(r) for r in frame.collect()]
    assert len(got) == len(set(got)) and set(got) == want
    capped = blocking.rule_candidates(left, right, None, per_record, more)
    assert {tuple(r) for r in more.collect()} <= {tuple(r) for r in capped.collect()}


def test_spent_tables_are_removed(spark):
    """tables that only led to another are removed once that one stands."""
    from tallyweave.plans.durable import cut, mark

    kept = cut(spark.range(3), "kept")
    since = mark()
    spent = cut(spark.range(5), "spent")
    path = spent.inputFiles()[0]
    last = cut(spent.selectExpr("id + 1 as id"), "last", since=since)
    import os

    assert not os.path.exists(path.removeprefix("file://")) and mark() == since + 1
    assert kept.count() == 3 and last.agg(F.sum("id")).first()[0] == 15


def test_pair_cosines_send_no_terms_with_pairs(spark, monkeypatch):
    """cosines of given pairs by vectors of numbered terms are those of a join of all terms, also of records in several countries and unknown ones."""
    monkeypatch.setattr(retrieval, "PAIR_PART", 20)
    monkeypatch.setattr(retrieval, "CHUNK", 30)
    rng = random.Random(12)
    words = ["".join(rng.choices("abcdeé", k=rng.randint(1, 4))) for _ in range(30)]
    rows = [(f"S{side}-{k % 60:03d}", rng.choice(["usa", "usa", "india", ""]), " ".join(rng.choices(words, k=rng.randint(0, 6)))) for side, n in ((1, 70), (2, 80)) for k in range(n)]
    every = spark.createDataFrame(rows, "entity_id string, country_key string, t string")
    left, right = (every.filter(F.col("entity_id").startswith(s)) for s in ("S1", "S2"))
    pairs = spark.createDataFrame([(f"S1-{rng.randrange(65):03d}", f"S2-{rng.randrange(65):03d}") for _ in range(600)], "s1_id string, cand_id string")
    weights = retrieval.term_weights(retrieval.both_sides(left, right, F.col("t")), retrieval.word_grams(F.col("text"))).collect()
    want = {tuple(r): 0.0 for r in pairs.collect()}
    by = {}
    for r in weights:
        by.setdefault((r.side, r.entity_id), {})[r.country, r.term] = r.w
    for a, b in want:
        x, y = by.get((1, a), {}), by.get((2, b), {})
        want[a, b] = sum(v * y.get(k, 0.0) for k, v in x.items())
    frame = retrieval.pair_cosines(pairs, left, right, F.col("t"))
    got = [tuple(r) for r in frame.collect()]
    assert len(got) == len(want) and {(a, b): pytest.approx(v, abs=1e-9) for a, b, v in got} == want
    assert sum(v > 0 for v in want.values()) > 30
    # A join of terms would shuffle them beside the pairs.
    assert "term" not in frame._jdf.queryExecution().executedPlan().toString()


def test_rows_that_few_records_ask_for(spark):
    """right rows of blocks that no labelled record asks for are left out before they are shuffled; candidates stay the same."""
    left, right = two_sides(spark, 60)
    right = right.unionByName(records(spark, [(f"S2-9{k:08d}", f"other{k}", "", "IN") for k in range(200)]))
    some = left.filter("entity_id < 'S1-000000005'")
    rows, asks = blocking.block_keys(right, True).select("entity_id", "block"), blocking.block_keys(some, False)
    wanted = {r.block for r in asks.collect()}
    kept, every = ([tuple(r) for r in d.collect()] for d in (blocking.rows_asked_for(rows, asks), rows))
    assert {r for r in kept if r[1] in wanted} == {r for r in every if r[1] in wanted} and len(kept) < len(every) / 2
    few, plain = ({tuple(r) for r in blocking.rule_candidates(some, right, few=x).collect()} for x in (True, False))
    assert few == plain != set()


def test_pseudo_labels_share_records_and_weights(spark, monkeypatch):
    from unittest.mock import MagicMock

    from tallyweave import catalogue

    made = []
    monkeypatch.setattr(catalogue, "_both", lambda *_: made.append("records") or [MagicMock(), MagicMock()])
    monkeypatch.setattr(catalogue, "_weights", lambda *_: made.append("weights") or MagicMock())
    monkeypatch.setattr(catalogue, "truth", lambda *_: MagicMock())
    monkeypatch.setattr(catalogue, "cut", lambda df, *_: df)
    for module in ("blocking", "decide", "features"):
        monkeypatch.setattr(catalogue, module, MagicMock())
    monkeypatch.setattr(catalogue.model, "pseudo_label_rounds", lambda *_: (MagicMock(), []))
    catalogue.pseudo_label_scores(spark, "")
    assert made == ["records", "weights"]


@pytest.mark.parametrize("form", ["S2-{:09d}", "{}x"])
def test_whole_blocks_in_parts(spark, form):
    """all pairs that share a key are found, with the number of their keys, where blocks are split and ids are repeated."""
    rows = lambda n, ids: [(ids(k), f"acme {k % 7} works", f"{k} main st 56000{k % 10}", ("IN", "US", "")[k % 3]) for k in range(n)]
    right = rows(150, form.format)
    left, right = with_country_keys(*(normalized(spark.createDataFrame(r, RECORD)) for r in ([*rows(20, "S1-{:09d}".format), ("S1-none", "", "", "IN")], right + right[:40])))
    pairs = blocking.capped_candidates(left, right, per_key=None).distinct()
    want = {(r.s1_id, r.cand_id): r["count"] for r in pairs.groupBy("s1_id", "cand_id").count().collect()}
    frame, codes = blocking.candidate_runs(left, right, None, part=5)
    seen = {r.s1_id: codes.unpacked(np.array(r.runs)) for r in frame.collect()}
    got = Counter((s, i.decode()) for s, run in seen.items() for i in codes.texts(np.asarray(run)))
    assert got == want and max(want.values()) > 2 and len(seen) == 21 and not len(seen["S1-none"])
    assert {tuple(r) for r in blocking.rule_candidates(left, right, None, None).collect()} == want.keys()


def test_link_takes_all_that_share_a_key(spark, monkeypatch):
    """F1: no cap drops a candidate before pairs are scored: the only right record of a left one may be any of its block."""
    from tallyweave.plans import pipeline

    class Sure:
        def score(self, matrix):
            return matrix.withColumn("proba", F.lit(0.9))

    nothing = spark.createDataFrame([], "s1_id string, cand_id string, label int, proba double")
    monkeypatch.setattr(pipeline, "learn", lambda *_: (Sure(), nothing))
    left = spark.createDataFrame([("S1-000000001", "acme textile works", "", "IN")], RECORD)
    right = spark.createDataFrame([(f"S2-{k:09d}", f"acme own{k}", "", "IN") for k in range(300)], RECORD)
    truth = spark.createDataFrame([("S1-000000001", ["S2-000000007"])], "s1_id string, targets array<string>")
    matches, found, _ = pipeline.link(left, right, truth)
    assert found.count() == found.distinct().count() == 300 and matches.count() == 300
    _, capped, _ = pipeline.link(left, right, truth, pipeline.Options(per_key=75, per_record=200))
    assert capped.count() < 150


def test_pairs_scored_in_rounds_are_those_scored_together(spark, monkeypatch):
    """F1: all pairs are scored in rounds of left records; ranks and gaps among a record's candidates stay the same."""
    from tallyweave.plans import pipeline

    class Ranked:
        def score(self, matrix):
            return matrix.withColumn("proba", F.col("composite_sim") / 2 + F.col("sim_percentile") / 4 + F.col("cand_count_for_s1") / 10_000)

    nothing = spark.createDataFrame([], "s1_id string, cand_id string, label int, proba double")
    monkeypatch.setattr(pipeline, "learn", lambda *_: (Ranked(), nothing))
    rows = lambda n, side: spark.createDataFrame([(f"{side}-{k:09d}", f"acme {k % 7} works", f"{k} main st 56000{k % 10}", "IN") for k in range(n)], RECORD)
    truth = spark.createDataFrame([("S1-000000001", ["S2-000000001"])], "s1_id string, targets array<string>")
    linked = lambda: sorted((r.s1_id, r.cand_id, round(r.proba, 9)) for r in pipeline.link(rows(20, "S1"), rows(60, "S2"), truth)[0].collect())
    together = linked()
    monkeypatch.setattr(pipeline, "ROUND", 300)
    monkeypatch.setattr(pipeline, "TASK", 40)
    assert linked() == together and len(together) == 20
    assert pipeline.link(rows(0, "S1"), rows(60, "S2"), truth)[0].count() == 0
