import random

from tallyweave.llm import topn


def brute(rows, n):
    best = {}
    for g, i, s in rows:
        best[g, i] = max(best.get((g, i), s), s)
    out = {}
    for (g, i), s in best.items():
        out.setdefault(g, []).append((-s, i))
    return {(g, i) for g, v in out.items() for _, i in sorted(v)[:n]}


def test_against_brute_force(spark):
    rng = random.Random(4)
    for ties in (3, 100):
        rows = [("hot", f"i{rng.randrange(500)}", rng.randrange(ties) / ties) for _ in range(3000)] + [(f"g{rng.randrange(60)}", f"i{rng.randrange(40)}", rng.randrange(ties) / ties) for _ in range(1500)]
        df = spark.createDataFrame(rows, "grp string, item string, score double")
        got = [(r.grp, r.item) for r in topn.top_n(df, 10).collect()]
        assert len(got) == len(set(got)) and set(got) == brute(rows, 10)


def test_dirt(spark):
    rows = [
        ("S1-1", " S2-1 ,S3-2,,S1-9,", [0.5, 0.5, 0.9, 0.9], "x"),
        ("S1-1", "S2-1,S2-5", [None, float("nan")], None),
        ("S1-1", "S2-6,S2-7", [0.1], "x"),
        ("S1-2", None, [0.1], "x"), ("S1-2", "", [], "x"), ("S1-3", "S2-1", None, "x"), (None, "S2-1", [0.4], "x"),
    ]
    df = spark.createDataFrame(rows, "source1_entity_id string, candidate_entity_ids string, candidate_scores array<double>, grp string")
    got = [(r.grp, r.item, r.score) for r in topn.top_n(topn.scored_items(df)).orderBy("rank").collect()]
    assert got == [("S1-1", "S2-1", 0.5), ("S1-1", "S3-2", 0.5), ("S1-1", "S2-6", 0.1)]
    assert topn.top_n(topn.scored_items(df.limit(0))).count() == 0
