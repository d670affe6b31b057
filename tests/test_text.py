import re
import unicodedata

from hypothesis import HealthCheck, example, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyweave.functions import text as T

NAMES = [
    ("Smith & Sons", "smith and sons", "sons", "smith"),
    ("Acme Bro", "acme bro", "", "acme"),
    ("Acme and Son", "acme and son", "", "acme"),
    ("Tech Solutions", "tech solutions", "tech", ""),
    ("Coast", "coast", "", "coast"),
    ("ﬁrm №5", "firm no5", "", "firm no5"),
    ("Société", "société", "", "société"),
    ("Private Limited Ltd", "private limited ltd", "pvt", ""),
    ("", "", "", ""),
    (None, "", "", ""),
    ("  A\tB ", "a b", "", "a b"),
]


def run(spark, rows):
    df = spark.createDataFrame(rows, "entity_id string, business_name string, business_address string, country string, name_norm int")
    return {r.entity_id: r for r in T.normalized(df).collect()}


def test_names(spark):
    out = run(spark, [(str(k), n, None, None, 1) for k, (n, *_) in enumerate(NAMES)])
    for k, (_, norm, suffix, core) in enumerate(NAMES):
        r = out[str(k)]
        assert (r.name_norm, r.legal_suffix, r.name_core) == (norm, suffix, core)
        assert r.name_ntoken == len(norm.split()) and r.name_len == len(norm)


ADDRESSES = [
    ("St Louis", "street louis", "", ""),
    ("5 ft", "5 suite", "", "5"),
    ("560001 x", "560001 x", "560001", "560001"),
    ("1234567", "1234567", "", "1234567"),
    ("12bc 4", "12bc 4", "", "4"),
    ("12 N. Main St, Near X", "12 north main street near x", "", "12"),
    (None, "", "", ""),
]


def test_addresses(spark):
    out = run(spark, [(str(k), None, a, " in ", 1) for k, (a, *_) in enumerate(ADDRESSES)])
    for k, (_, norm, pin, number) in enumerate(ADDRESSES):
        r = out[str(k)]
        assert (r.address_norm, r.pincode, r.street_num) == (norm, pin, number)
        assert r.country_norm == "IN"
    assert out["5"].has_landmark == 1 and out["0"].has_landmark == 0


def test_empty_table(spark):
    df = spark.createDataFrame([], "entity_id string, business_name string, business_address string, country string")
    assert T.normalized(df).count() == 0


def test_id_lists(spark):
    df = spark.createDataFrame([(" a, b ,,a",), ("",), (None,), (",",)], "c string")
    out = [r[0] for r in df.select(T.parse_id_list(F.col("c"))).collect()]
    assert out == [["a", "b"], [], [], []]


@settings(max_examples=60, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@example(texts=["\u0870x", "A\u0301&B_\u00b2", "\u0345", "İ ﬁ"])
@given(texts=st.lists(st.text(alphabet=st.characters(codec="utf-8", exclude_categories=("Cs",)), max_size=20), min_size=1, max_size=6))
def test_normal_words_match_python(spark, texts):
    df = spark.createDataFrame([(t,) for t in texts], "c string")
    got = [r[0] for r in df.select(T.normal_words(F.col("c"))).collect()]
    for t, g in zip(texts, got, strict=True):
        low = re.sub(r"[^\w\s]", " ", unicodedata.normalize("NFKC", t).lower().replace("&", " and "))
        assert g == re.sub(r"\s+", " ", low).strip()
