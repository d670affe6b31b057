"""What the words of names and addresses are, learnt from the tables themselves.

A frequent word of names that stands after the own words of a name is a trade, one
before them a given name or another prefix. Words are one class where one hardly
stands without the other (``printing press``), or where records of equal own words
have the one in the place of the other (``bakery``, ``bkry``): abbreviations and nicknames
are found by what they replace, not by a list. A frequent word of addresses names a
place of its own only if nearly all its addresses share the beginning of a postcode, as
those of a town do; states, landmarks and parts of towns are spread over many.
"""

from __future__ import annotations

import unicodedata
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyweave.llm.records import FIXED_WORDS, FORM_WORDS, Vocabulary
from tallyweave.plans.durable import cut

#: Least share and number of the records that hold a frequent word. At most words / SHARE words are frequent, however many records there are.
SHARE, LEAST = 0.0005, 20
#: Buckets of word digests; a bucket holds words / BUCKETS of all words by chance, far below SHARE of the records.
BUCKETS = 65_536
#: Part of the groups of equal own words holding a word that also hold its substitute, and of its records that hold its companion.
REPLACED, TOGETHER = 0.5, 0.8
#: Part of a substitute's records that may hold both words, and least groups that must show a substitution.
BOTH, SEEN = 0.03, 4
#: Part of the records of a town's word that share the first two digits of their postcodes.
LOCAL = 0.7

_accented = {chr(k): unicodedata.normalize("NFKD", chr(k))[0] for k in range(0xC0, 0x180) if len(unicodedata.normalize("NFKD", chr(k))) > 1}
_FROM, _TO = "".join(_accented), "".join(_accented.values())


def words(c: Column) -> Column:
    """Words of two and more Latin letters, without case and accents; other scripts and widths are counted as no words."""
    text = F.coalesce(c, F.lit(""))
    bare = F.when(text.rlike(r"[^\x00-\x7F]"), F.translate(text, _FROM, _TO)).otherwise(text)
    return F.regexp_extract_all(F.lower(bare), F.lit("[a-z]{2,}"), F.lit(0))


def _bucket(word: Column, kind: int) -> Column:
    return F.pmod(F.xxhash64(word, F.lit(kind)), F.lit(BUCKETS)).cast("int")


def full_buckets(rows: DataFrame, columns: list[str], least: float) -> list[int]:
    """Buckets of word digests with enough words to hold a frequent one; no frequent word is in another.

    Most words are rare, and counting a fixed number of buckets first keeps them out of every shuffle.
    """
    of = lambda kind, c: F.transform(F.array_distinct(words(F.col(c))), lambda w: _bucket(w, kind))
    counted = rows.select(F.explode(F.concat(*(of(k, c) for k, c in enumerate(columns)))).alias("b")).groupBy("b").agg(F.count("*").alias("n"))
    return sorted(r.b for r in counted.filter(F.col("n") >= least).collect())  # at most BUCKETS


def _likely(c: str, kind: int, full: list[int]) -> Column:
    """Distinct words of a column that may be frequent."""
    return F.filter(F.array_distinct(words(F.col(c))), lambda w: _bucket(w, kind).isin(full))


def spread_words(rows: DataFrame, least: float, kind: int, full: list[int]) -> list[str]:
    """Frequent words of addresses that stand with postcodes of many beginnings."""
    post = F.substring(F.regexp_extract("business_address", r"\b(\d{5,6})\b", 1), 1, 2)
    each = rows.select(post.alias("post"), F.explode(_likely("business_address", kind, full)).alias("word"))
    by_post = each.groupBy("word", "post").agg(F.count("*").alias("n"))
    counted = by_post.groupBy("word").agg(F.sum("n").alias("n"), F.max(F.when(F.col("post") != "", F.col("n"))).alias("top"), F.sum(F.when(F.col("post") != "", F.col("n"))).alias("placed"))
    found = counted.filter((F.col("n") >= least) & (F.col("placed") >= LEAST) & (F.col("top") < LOCAL * F.col("placed"))).select("word").collect()  # at most words / SHARE
    return sorted(r.word for r in found if r.word not in FIXED_WORDS)


def name_classes(rows: DataFrame, least: float, kind: int, full: list[int]) -> tuple[dict[str, str], dict[str, str]]:
    """``(trades, givens)``: class of each frequent word of names, by its smallest word."""
    each = rows.select(words(F.col("business_name")).alias("w"))
    counted = rows.select(F.explode(_likely("business_name", kind, full)).alias("word")).groupBy("word").agg(F.count("*").alias("n"))
    frequent = sorted(r.word for r in counted.filter(F.col("n") >= least).select("word").collect() if r.word not in FORM_WORDS)  # at most words / SHARE
    if not frequent:
        return {}, {}
    known = [*frequent, *FORM_WORDS]
    own = F.filter("w", lambda x: (F.length(x) > 2) & ~x.isin(known))
    list_of = F.array(*map(F.lit, frequent))
    # Words that stand after the first own one.
    late = F.when(F.size("own") > 0, F.slice("w", F.array_position("w", F.element_at("own", 1)).cast("int"), F.size("w"))).otherwise(F.array().cast("array<string>"))
    parts = each.withColumn("own", own).withColumn("late", late)
    core = F.when(F.size("own") >= 2, F.xxhash64(F.array_sort("own")))
    numbered = lambda c: F.array_distinct(F.transform(F.filter(c, lambda x: x.isin(frequent)), lambda x: F.array_position(list_of, x).cast("int")))
    parts = parts.select(core.alias("core"), (F.size("own") > 0).alias("placed"), numbered("w").alias("g"), numbered("late").alias("late"))
    parts = cut(parts.filter("core is not null or size(g) > 0"), "name-words")
    # How often each word stands at all, with own words and after them, and with each other word.
    alone = F.transform("g", lambda x: F.struct(x.alias("x"), F.lit(0).alias("y"), F.when(F.col("placed"), 1).otherwise(0).alias("placed"), F.when(F.array_contains("late", x), 1).otherwise(0).alias("late")))
    both = F.flatten(F.transform("g", lambda x: F.transform(F.filter("g", lambda y: y != x), lambda y: F.struct(x.alias("x"), y.alias("y"), F.lit(0).alias("placed"), F.lit(0).alias("late")))))
    stands = parts.select(F.explode(F.concat(alone, both)).alias("p")).select("p.*").groupBy("x", "y").agg(F.count("*").alias("n"), F.sum("placed").alias("placed"), F.sum("late").alias("late"))
    stands = stands.filter("y = 0").withColumnRenamed("n", "all").select("x", "all", F.col("placed").alias("own"), F.col("late").alias("after")).join(stands.filter("y > 0").select("x", "y", "n"), "x", "left")
    kept = stands.groupBy("x").agg(F.first("all").alias("all"), F.first("own").alias("own"), F.first("after").alias("after"), F.collect_list(F.when(F.col("n") >= BOTH * F.col("all"), F.struct("y", "n"))).alias("with")).collect()  # at most 1 / BOTH words of a record each
    # Words of the records of equal own words: a substitute is in the group, but not in the record.
    grouped = parts.filter("core is not null").select("core", F.explode(F.concat("g", F.array(F.lit(0)))).alias("x")).groupBy("core", "x").agg(F.count("*").alias("n"))
    many = grouped.filter("x = 0 and n > 1").select("core")
    inside = grouped.filter("x > 0").select("core", "x").join(many, "core", "left_semi")
    pairs = inside.join(inside.withColumnRenamed("x", "y"), "core").groupBy("x", "y").agg(F.count("*").alias("n"))
    of = pairs.filter("x = y").select("x", F.col("n").alias("groups"))
    swapped = pairs.filter("x <> y").join(of, "x").filter((F.col("n") >= REPLACED * F.col("groups")) & (F.col("n") >= SEEN)).select("x", "y").collect()  # bounded as above
    return _classes(frequent, kept, [(r.x, r.y) for r in swapped])


def _classes(frequent: list[str], kept: list, swapped: list[tuple[int, int]]) -> tuple[dict[str, str], dict[str, str]]:
    head = list(range(len(frequent) + 1))

    def find(x: int) -> int:
        while head[x] != x:
            x = head[x]
        return x

    def join(x: int, y: int) -> None:
        x, y = find(x), find(y)
        head[max(x, y)] = min(x, y)

    held = {r.x: {p.y: p.n for p in r["with"]} for r in kept}
    for r in kept:
        for y, n in held[r.x].items():
            if n >= TOGETHER * r.all:
                join(r.x, y)
    for x, y in swapped:
        if y not in held.get(x, {}):
            join(x, y)
    own, after = {}, {}
    for r in kept:
        own[find(r.x)] = own.get(find(r.x), 0) + r.own
        after[find(r.x)] = after.get(find(r.x), 0) + r.after
    trades, givens = {}, {}
    for k, word in enumerate(frequent, 1):
        root = find(k)
        (trades if 2 * after.get(root, 0) >= own.get(root, 0) else givens)[word] = frequent[root - 1]
    return trades, givens


def learn(tables: list[DataFrame], names: bool = True, addresses: bool = True) -> Vocabulary:
    """The vocabulary of all rows of ``tables``; words of fewer than :data:`LEAST` records stay own words and places.

    Null and empty texts hold no words; empty tables give an empty vocabulary.
    """
    rows = reduce(DataFrame.unionByName, [t.select(F.col("business_name").cast("string"), F.col("business_address").cast("string")) for t in tables])
    least = max(LEAST, SHARE * rows.count())
    columns = ["business_name"] * names + ["business_address"] * addresses
    full = full_buckets(rows, columns, least) if columns else []
    trades, givens = name_classes(rows, least, 0, full) if names else ({}, {})
    return Vocabulary.of(trades, givens, spread_words(rows, least, len(columns) - 1, full) if addresses else ())
