from difflib import SequenceMatcher

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyweave.functions import similarity as S
from tallyweave.functions import vocabulary as V

PAIRS = [("kitten", "sitting"), ("tide", "diet"), ("diet", "tide"), ("", "a"), ("", ""), ("same", "same"), ("a b c", "c b d"), ("x" * 150 + "abc" * 30, "abc" * 80), ("jaya textiles", "jaia textile"), ("shree wala", "shri vala")]


def frame(spark):
    return spark.createDataFrame([(k, a, b) for k, (a, b) in enumerate(PAIRS)], "k int, a string, b string")


def values(spark, column):
    return [r.v for r in frame(spark).select("k", column.alias("v")).orderBy("k").collect()]


def test_sequence_ratio(spark):
    want = [0.0 if not a or not b else SequenceMatcher(None, a, b).ratio() for a, b in PAIRS]
    assert values(spark, S.sequence_ratio(F.col("a"), F.col("b"))) == pytest.approx(want)
    assert want[0] == pytest.approx(0.6153846) and (want[1], want[2]) == (0.25, 0.5)


def test_jaccards(spark):
    words = lambda a, b: 0.0 if not a or not b else len(set(a.split()) & set(b.split())) / len(set(a.split()) | set(b.split()))
    assert values(spark, S.token_jaccard(F.col("a"), F.col("b"))) == pytest.approx([words(a, b) for a, b in PAIRS])

    def grams(a, b):
        x, y = ({s[i : i + 3] for i in range(len(s) - 2)} for s in (a, b))
        return len(x & y) / len(x | y) if x and y else 0.0

    assert values(spark, S.char_jaccard(F.col("a"), F.col("b"))) == pytest.approx([grams(a, b) for a, b in PAIRS])


def test_length_ratios(spark):
    want = [1.0 if not a and not b else min(len(a), len(b)) / max(len(a), len(b)) for a, b in PAIRS]
    assert values(spark, S.length_ratio(F.col("a"), F.col("b"))) == pytest.approx(want)
    assert values(spark, S.token_count_ratio(F.lit(1), F.lit(3)))[0] == pytest.approx(0.2)


def test_variants(spark):
    def rewrite(a, b):
        for x, y, _ in V.VARIANTS:
            if x in a and y in b:
                b = b.replace(y, x)
        return b

    assert values(spark, S.variant_rewritten(F.col("a"), F.col("b"))) == [rewrite(a, b) for a, b in PAIRS]


def test_token_set_ratio(spark):
    def want(a, b):
        x, y = set(a.split()), set(b.split())
        if not x & y:
            return 0.0
        t0, t1, t2 = (" ".join(sorted(z)) for z in (x & y, x, y))
        r = lambda p, q: SequenceMatcher(None, p, q).ratio()
        return max(r(t0, t1), r(t0, t2), r(t1, t2))

    assert values(spark, S.token_set_ratio(F.col("a"), F.col("b"))) == pytest.approx([want(a, b) for a, b in PAIRS])


def test_jaro_winkler():
    assert S.jaro_winkler("martha", "marhta") == pytest.approx(0.9611111)
    assert S.jaro_winkler("dixon", "dicksonx") == pytest.approx(0.8133333)
    assert S.jaro_winkler("", "") == 0.0 and S.jaro_winkler("a", "") == 0.0


@settings(max_examples=400, deadline=None)
@given(st.text(alphabet="abc é", max_size=40), st.text(alphabet="abc é", max_size=40))
def test_matching_ratio_equals_the_library(a, b):
    assert S.matching_ratio(a, b) == SequenceMatcher(None, a, b).ratio()


@given(st.lists(st.tuples(st.text("ab cé한𝒳", max_size=40), st.text("ab cé한𝒳", max_size=40)), max_size=30))
@settings(max_examples=60, deadline=None)
def test_many_ratios_at_once(pairs):
    pairs = pairs + PAIRS + [("ab" * 120, "ba" * 60), ("abc" * 66, "cba" * 66)]
    assert S.matching_ratios(pairs).tolist() == [SequenceMatcher(None, a, b).ratio() for a, b in pairs]
    assert S.distinct_ratios([(None, "a"), ("", "a"), ("a", "a"), *pairs]).tolist()[:3] == [0.0, 0.0, 1.0]


def test_ratios_visit_python_once(spark):
    both = {"there": (F.col("a"), F.col("b")), "back": (F.col("b"), F.col("a"))}
    rows = frame(spark).select("k", *(c.alias(n) for n, c in S.sequence_ratios(both).items()))
    want = [tuple(0.0 if not x or not y else SequenceMatcher(None, x, y).ratio() for x, y in ((a, b), (b, a))) for a, b in PAIRS]
    assert [(r.there, r.back) for r in rows.orderBy("k").collect()] == want
    evaluated = [x for x in rows._jdf.queryExecution().executedPlan().toString().splitlines() if "ArrowEvalPython" in x]
    assert len(evaluated) == 1 and evaluated[0].count("each(") == 1


def test_weighted_jaccard(spark):
    side = "struct<words: array<bigint>, idfs: array<double>, total: double>"
    rows = spark.createDataFrame([(([1, 2], [1.5, 2.0], 3.5), ([3, 2], [4.0, 2.0], 6.0)), (([], [], 0.0), ([], [], 0.0)), (([1], [1.5], 1.5), ([], [], 0.0))], f"a {side}, b {side}")
    assert [r.v for r in rows.select(S.weighted_jaccard(F.col("a"), F.col("b")).alias("v")).collect()] == [pytest.approx(2.0 / 7.5), 0.0, 0.0]
