"""Link business records by name and address without a shared key."""

from __future__ import annotations

import math
from collections.abc import Callable, Iterator
from functools import reduce

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from tallyweave.llm import records
from tallyweave.llm.arrow import map_rows
from tallyweave.llm.vocabulary import learn
from tallyweave.plans.durable import cut

#: A key of more rows than this on either side is split by the house or trade of its rows.
HOT = 64
#: Rows of a side of a hot key that meet the other side's in one part of a join, about.
PART = 2_000


def parsed(tables: dict[str, DataFrame], keys: Callable[[str, str, str], list[int]] | None = None, names: bool = True, addresses: bool = True, vocabulary: records.Vocabulary | None = None) -> DataFrame:
    """``(src, id, n, a, country)`` of all tables, distinct, written once.

    ``n`` and ``a`` are the codes of :mod:`records`, '' for a missing text and where
    ``names`` or ``addresses`` are not wanted; ``vocabulary`` is learnt from the tables
    unless one is given. With ``keys``, a function of src, n and a, the column ``keys`` is added.
    Rows without an id are left out; repeated rows of an id are one record, and rows
    of one id with different texts are compared in each of their forms.
    """
    words = learn(list(tables.values()), names, addresses) if vocabulary is None else vocabulary
    texts = {"business_name": names, "business_address": addresses, "country": True}
    each = [t.select(F.lit(src).alias("src"), F.col("entity_id").cast("string").alias("id"), *((F.col(c) if wanted else F.lit(None)).cast("string").alias(c) for c, wanted in texts.items())) for src, t in tables.items()]
    every = reduce(DataFrame.unionByName, each).filter("id is not null").distinct()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            src, ids, *columns = batch.columns
            typed, placed, countries = (c.to_pylist() for c in columns)
            n, a = [records.name_code(x, words) for x in typed], [records.address_code(x, words) for x in placed]
            out = [src, ids, pa.array(n, pa.string()), pa.array(a, pa.string()), pa.array(map(records.country_code, countries), pa.string())]
            if keys:
                own = list(map(keys, src.to_pylist(), n, a))
                ends = np.cumsum([0, *map(len, own)], dtype=np.int32)
                out.append(pa.ListArray.from_arrays(pa.array(ends), pa.array([k for x in own for k in x], pa.int64())))
            yield pa.RecordBatch.from_arrays(out, names=["src", "id", "n", "a", "country", "keys"][: len(out)])

    return cut(every.mapInArrow(run, "src string, id string, n string, a string, country string" + ", keys array<bigint>" * bool(keys)), "parsed")


def part(code: str, k: int) -> Column:
    """The k-th part, from 1, of a code column."""
    return F.substring_index(F.substring_index(F.col(code), "|", k), "|", -1)


def whole_keys(left: DataFrame, right: DataFrame, hot: int = HOT, texts: int = PART, reads: int = PART) -> tuple[DataFrame, DataFrame]:
    """``(id, key)`` of both sides from rows ``(id, keys, house)``, so that all rows that share a key and don't contradict share a key here.

    ``house`` is a part of a row, such as the house or the trade, in which rows must
    not contradict: '' where it is missing, null where the row meets only rows
    with null (:func:`overlap.same_record` wants both addresses or none). A key of
    more than ``hot`` rows of a side is split by it: equal parts meet, and rows without
    it meet all. What then still has more than ``texts`` left or ``reads`` right
    rows is split into parts of both sides, every left part meeting every right one.
    """
    exploded = lambda d: d.select("id", "house", F.explode("keys").alias("key"))
    counts = [exploded(d).groupBy("key").count() for d in (left, right)]
    many = cut(reduce(DataFrame.union, [c.filter(F.col("count") > hot).select("key") for c in counts]).distinct(), "hot")
    if many.isEmpty():
        return exploded(left).select("id", "key"), exploded(right).select("id", "key")
    cold = [exploded(d).join(many, "key", "left_anti").select("id", "key") for d in (left, right)]

    def split(d: DataFrame, with_house: str, without: str) -> DataFrame:
        kinds = F.when(F.col("house").isNull(), F.array(F.lit("n"))).when(F.col("house") == "", F.array(F.lit("h"), F.lit(without))).otherwise(F.array(F.concat(F.lit("h"), "house"), F.lit(with_house)))
        rows = exploded(d).join(many, "key", "left_semi").select("id", "key", F.explode(kinds).alias("kind"))
        return rows.select("id", F.xxhash64("key", "kind").alias("key"))

    hots = [cut(split(left, "e", "t"), "keys"), cut(split(right, "t", "e"), "keys")]
    sizes = [d.groupBy("key").agg(F.ceil(F.count("*") / most).alias(n)) for d, n, most in ((hots[0], "parts", texts), (hots[1], "reads", reads))]
    parts = cut(sizes[0].join(sizes[1], "key").filter("parts > 1 or reads > 1"), "parts")

    def placed(d: DataFrame, mine: str, theirs: str) -> DataFrame:
        of = d.join(parts, "key", "left").na.fill(1, ["parts", "reads"])
        of = of.select("id", "key", "parts", "reads", F.pmod(F.xxhash64("id"), F.col(mine)).alias(f"{mine}_at"), F.explode(F.sequence(F.lit(0).cast("long"), F.col(theirs) - 1)).alias(f"{theirs}_at"))
        alone = (F.col("parts") == 1) & (F.col("reads") == 1)
        return of.select("id", F.when(alone, F.col("key")).otherwise(F.xxhash64("key", "parts_at", "reads_at")).alias("key"))

    return cold[0].unionByName(placed(hots[0], "parts", "reads")), cold[1].unionByName(placed(hots[1], "reads", "parts"))


def shared_pairs(left: DataFrame, right: DataFrame, hot: int = HOT) -> DataFrame:
    """``(l, r)`` of rows ``(id, keys, house)`` for each key they share, without contradictions of hot ones as in :func:`whole_keys`."""
    a, b = whole_keys(left, right, hot)
    return a.withColumnRenamed("id", "l").join(b.withColumnRenamed("id", "r"), "key").select("l", "r")


def whole_pairs(left: DataFrame, right: DataFrame, hot: int = HOT) -> DataFrame:
    """Distinct pairs of :func:`shared_pairs`."""
    return shared_pairs(left, right, hot).distinct()


def with_codes(pairs: DataFrame, left: DataFrame, right: DataFrame, columns: tuple[str, ...]) -> DataFrame:
    """``pairs (l, r)`` with the ``columns`` of both rows, suffixed _l and _r."""
    a = left.select(F.col("id").alias("l"), *(F.col(c).alias(f"{c}_l") for c in columns))
    b = right.select(F.col("id").alias("r"), *(F.col(c).alias(f"{c}_r") for c in columns))
    return pairs.join(a, "l").join(b, "r")


# ---------------------------------------------------------------- one business in several sources


#: Least log odds of a candidate pair; below, the pair is as unlikely as any two records of a country.
UNLIKELY = -9.0


def match_weight(n1: str, a1: str, n2: str, a2: str, c1: str = "", c2: str = "") -> float | None:
    """Log odds that two records are one business by themselves; None where they are no candidates.

    A contradicting part of the place makes a pair unlikely, not impossible: it stays a rival of
    the other candidates of its records. Another country, trade or number ends a pair.
    """
    if c1 and c2 and c1 != c2:
        return None
    name, place = records.name_cost(n1, n2), records.address_evidence(a1, a2)
    if name == 9.0 or name is None and place is None:
        return None
    if name is None:
        return 2.0 * (place[0] - 2.6) if place[1] >= 2 else None
    if name >= 1.3:
        return None
    if place is None:
        return 2.5 - 3.5 * name - (2.0 if name >= 0.8 else 0.0)
    weight = 3.0 - 4.0 * name + 1.2 * (place[0] - 1.0)
    if place[0] < 0:
        weight = -3.0 - 4.0 * name + place[0]
    elif name >= 0.9 and place[0] < 2.5:
        weight -= 2.0
    return weight


def _contradict() -> Column:
    """Pairs of codes that name another house, trade or number: told apart before any text is compared."""
    differ = lambda c, k: (part(f"{c}_l", k) != part(f"{c}_r", k)) & (part(f"{c}_l", k) != "") & (part(f"{c}_r", k) != "")
    places = (F.col("a_l") != "") & (F.col("a_r") != "") & differ("a", 1)
    return places | (F.col("n_l") != "") & (F.col("n_r") != "") & differ("n", 2)


def belief_keys(left_src: str) -> Callable[[str, str, str], list[int]]:
    """Keys of :func:`belief_matches`; only left records without need of it carry the bare street."""
    return lambda src, n, a: records.name_keys(n, outer=False) + records.address_keys(a, bare=src == left_src)


def capacity(labelled: DataFrame, sample: int = 5_000) -> list[float]:
    """How often a Source 1 record has 0, 1, 2, ... matches, from at most ``sample`` labelled rows, smoothed."""
    size = F.size(F.filter(F.split(F.coalesce("matched_entity_ids", F.lit("")), ","), lambda x: F.trim(x) != ""))
    found = labelled.select("source1_entity_id", size.alias("k")).orderBy("source1_entity_id").limit(sample).groupBy("k").count().collect()
    counts = {int(r.k): float(r["count"]) for r in found}
    top = max([6, *counts])
    total = sum(counts.values()) + 0.5 * (top + 2)
    return [(counts.get(k, 0.0) + 0.5) / total for k in range(top + 2)]


def belief_matches(parsed_rows: DataFrame, left_src: str, right_srcs: list[str], sizes: list[float], rounds: int = 60, tolerance: float = 0.01) -> DataFrame:
    """``(l, r, probability, prior)``: marginal match probability of every candidate pair of :func:`parsed` rows with their
    :func:`belief_keys`, and the probability the pair has by itself.

    Factors: a right record belongs to one left record or to none; a left record
    has as many right records as ``sizes`` makes likely (Sources 2 and 3 may hold
    several records of a business, so its side of the one-to-one factor is a soft
    count).
    """
    left = parsed_rows.filter(F.col("src") == left_src)
    right = parsed_rows.filter(F.col("src").isin(right_srcs))
    # A record without an address can match any, so it counts as one without a house.
    pairs = whole_pairs(*(d.select("id", "keys", part("a", 1).alias("house")) for d in (left, right)))
    full = with_codes(pairs, left, right, ("n", "a", "country")).filter(~_contradict())

    def rows(ls, rs, n1, a1, c1, n2, a2, c2):
        for x in zip(ls, rs, n1, a1, n2, a2, c1, c2, strict=True):
            w = match_weight(*x[2:])
            if w is not None and w > UNLIKELY:
                yield x[0], x[1], w

    picked = full.select("l", "r", "n_l", "a_l", "country_l", "n_r", "a_r", "country_r")
    weighted = map_rows(picked, rows, "l string, r string, w double")
    # A record with different texts is compared in each of its forms; its best one counts.
    edges = weighted.groupBy("l", "r").agg(F.max("w").alias("w"))
    # Log ratio of having one match more, by the number expected without it.
    ratio = [math.log(sizes[k + 1] / sizes[k]) - math.log(sizes[1] / sizes[0]) for k in range(len(sizes) - 1)]
    found = propagated(edges, [min(0.0, x) for x in ratio], rounds, tolerance)
    return found.select("l", "r", "probability", _probability(F.col("w")).alias("prior"))


def _probability(odds: Column) -> Column:
    return 1 / (1 + F.exp(-odds))


def propagated(edges: DataFrame, gains: list[float], rounds: int = 60, tolerance: float = 0.01) -> DataFrame:
    """``(l, r, w, probability)``: marginals of ``edges (l, r, w)`` by loopy belief propagation.

    A right record's message to a left one is what its other candidates leave of it;
    a left record's message to a right one is the gain of one match more at the number
    expected without it (``gains``, between whole numbers in proportion). Both are
    exchanged by grouped joins until no message moves by ``tolerance``; later rounds
    move half the way, so that messages can't swing, and more than ``rounds`` are an error.
    A pair of two records without other candidates gets no message but zero, and is
    at its fixed point from the start.
    """
    by_l, by_r = Window.partitionBy("l"), Window.partitionBy("r")
    crowd = edges.withColumn("at_l", F.count("*").over(by_l)).withColumn("at_r", F.count("*").over(by_r))
    start = cut(crowd.select("l", "r", "w", F.lit(0.0).alias("m"), ((F.col("at_l") == 1) & (F.col("at_r") == 1)).alias("alone")), "edges")
    table = F.array(*map(F.lit, [gains[0], *gains, gains[-1]][1:]))
    whole = F.least(F.floor("others"), F.lit(len(gains) - 1)).cast("int")
    step = F.col("others") - whole
    gain = F.element_at(table, whole + 1) + F.least(step, F.lit(1.0)) * (F.element_at(table, whole + 2) - F.element_at(table, whole + 1))
    odds = F.exp(F.least(F.col("w") + F.col("m"), F.lit(50.0)))
    claimed = odds / (1 + F.sum(odds).over(by_r))
    state, last = start.filter("not alone").drop("alone"), None
    for done in range(rounds):
        rate = 1.0 if done < 4 else 0.5
        seen = state.withColumn("p", claimed).withColumn("others", F.greatest(F.sum("p").over(by_l) - F.col("p"), F.lit(0.0)))
        moved = cut(seen.select("l", "r", "w", (F.col("m") + rate * (gain - F.col("m"))).alias("m"), F.abs(gain - F.col("m")).alias("move")), "messages")
        state = moved.drop("move")
        last = moved.agg(F.max("move")).first()[0] or 0.0
        if last < tolerance:
            break
    else:
        raise RuntimeError(f"messages still move by {last} after {rounds} rounds")
    contested = state.select("l", "r", "w", claimed.alias("probability"))
    return contested.unionByName(start.filter("alone").select("l", "r", "w", _probability(F.col("w")).alias("probability")))


# ---------------------------------------------------------------- one place, written differently


def place_code(a: str = "a") -> Column:
    """Address code without the unit, which does not tell buildings apart."""
    return F.concat(F.substring_index(F.col(a), "|", 4), F.lit("|"))


def same_place(a: str, b: str) -> float | None:
    """Weighted containment of the less full address in the other, None if a part contradicts or too little is shared."""
    found = records.address_evidence(a, b)
    if found is None or found[0] < 2.4:
        return None
    x, y = records.split_code(a), records.split_code(b)
    if not x[1] or not y[1] or found[1] < 2:
        return None
    parts = (1.0, 2.0, 0.7, 1.0)
    least = min(sum(w for w, p in zip(parts, z, strict=False) if p) for z in (x, y))
    share = found[0] / least
    return share if share >= 0.6 else None


def street_letters(a: str) -> tuple[str, str, int, int]:
    """``(joined, turned, letters, reach)`` of the street of an address code: its words joined, the first one last, its set of letters, and how many
    letters a street of :func:`records.words_cost` below 1 without an equal word can differ in.

    Such a cost allows as many edits as 1 / 0.7 of the unit of the longest word, or 0.9 of that of the joined
    words; a swap of letters counts as two. A single letter may stand for any word.
    """
    words = records.split_code(a)[1].split()
    joined = "".join(words)
    unit = lambda n: max(1.0, 0.3 * n)
    edits = 10**6 if min(map(len, words), default=1) == 1 else math.floor(max(unit(max(map(len, words))) / 0.7, 0.9 * unit(len(joined))))
    return joined, "".join(words[1:] + words[:1]), records.letters_of(joined), 2 * edits


def _maybe_one_street() -> Column:
    """Whether the streets of ``l`` and ``r`` may be one, by :func:`street_letters`."""
    most = F.greatest("l.reach", "r.reach")
    near = lambda x, y: F.levenshtein(F.col(f"l.{x}"), F.col(f"r.{y}")) <= most
    few = F.bit_count(F.col("l.letters").bitwiseXOR(F.col("r.letters"))) <= most
    return few & (near("joined", "joined") | near("joined", "turned") | near("turned", "joined"))


def same_address(parsed_rows: DataFrame, left_src: str, right_srcs: str, hot: int = HOT) -> DataFrame:
    """``(l, r)`` of records at one building or plot.

    Distinct addresses meet where they share a token (words of the street, the
    house with the town or the postcode), however common it is; tokens of many
    places are split by house as in :func:`whole_keys`. Addresses without a
    street name no place. An address without a house is the place of a fuller
    one only if all places it is contained in have one house number.
    """
    rows = parsed_rows.filter(F.col("src").isin(left_src, right_srcs) & (F.col("a") != "")).withColumn("place", place_code())
    rows = rows.filter(part("place", 2) != "")
    spread = rows.groupBy("place").agg(F.max(F.col("src") == left_src).alias("in_left"), F.max(F.col("src") == right_srcs).alias("in_right"))

    def tokens(codes, lefts, rights):
        for x in zip(codes, lefts, rights, strict=True):
            words, stands = records.place_tokens(x[0])
            yield (*x, words, stands, *street_letters(x[0]))

    places = cut(map_rows(spread, tokens, "place string, in_left boolean, in_right boolean, words array<bigint>, stands array<bigint>, joined string, turned string, letters bigint, reach int"), "places")
    number = lambda c: part(c, 1)
    # Another house is another place, and most that share house and town are on other streets: such pairs end before they are shuffled.
    apart = (number("l") != "") & (number("r") != "") & (number("l") != number("r"))
    by_word = [places.filter(wanted).select(F.col("place").alias("id"), F.col("words").alias("keys"), number("place").alias("house")) for wanted in ("in_left", "in_right")]
    by_house = [places.filter(wanted).select(F.struct("place", "joined", "turned", "letters", "reach").alias("id"), F.col("stands").alias("keys"), F.lit("").alias("house")) for wanted in ("in_left", "in_right")]
    one_word = shared_pairs(*by_word, hot).filter((F.col("l") != F.col("r")) & ~apart)
    one_house = shared_pairs(*by_house, hot).filter((F.col("l.place") != F.col("r.place")) & _maybe_one_street()).select(F.col("l.place").alias("l"), F.col("r.place").alias("r"))
    pairs = one_word.unionByName(one_house).distinct()

    def verified(ls, rs):
        for x, y in zip(ls, rs, strict=True):
            if same_place(x, y) is not None:
                yield x, y

    good = cut(map_rows(pairs, verified, "l string, r string"), "places-verified")
    open_l = good.filter((number("l") == "") & (number("r") != "")).groupBy("l").agg(F.countDistinct(number("r")).alias("n")).filter("n > 1").select("l")
    open_r = good.filter((number("r") == "") & (number("l") != "")).groupBy("r").agg(F.countDistinct(number("l")).alias("n")).filter("n > 1").select("r")
    closed_l = good.filter(number("l") == "").join(open_l, "l", "left_anti").unionByName(good.filter(number("l") != ""))
    closed = closed_l.filter(number("r") == "").join(open_r, "r", "left_anti").unionByName(closed_l.filter(number("r") != ""))
    same = places.filter("in_left and in_right").select(F.col("place").alias("l"), F.col("place").alias("r"))
    places_paired = closed.unionByName(same)
    a = rows.filter(F.col("src") == left_src).select(F.col("place").alias("l"), F.col("id").alias("id_l"))
    b = rows.filter(F.col("src") == right_srcs).select(F.col("place").alias("r"), F.col("id").alias("id_r"))
    return places_paired.join(a, "l").join(b, "r").select(F.col("id_l").alias("l"), F.col("id_r").alias("r"))


# ---------------------------------------------------------------- one name, spelled differently

#: Cost at which a spelling is as likely a name of its own; weight of a cost in log likelihood;
#: how much more a spelling in the tidy source counts.
#: and how much less a spelling without its trade or with initials.
OWN_NAME, COST_WEIGHT, TIDY, SHORTENED = 0.85, 9.0, 2.5, 0.01


def attributed_spellings(parsed_rows: DataFrame, tidy_src: str, typed_src: str) -> DataFrame:
    """``(n, root)``: each spelling with the canonical spelling of its organisation.

    Spellings are ranked by frequency, those of the tidy source counting more and
    shortened ones less.
    A spelling is attached to the more frequent one of greatest posterior: the
    prior is the frequency, the likelihood falls with typos, swapped, joined and
    shortened words and a trade left out; another trade or number has none. It
    stays its own if no posterior beats that of an own name. Attachments are
    followed to their end by pointer doubling.
    """
    named = parsed_rows.filter(F.col("src").isin(tidy_src, typed_src) & (F.col("n") != ""))
    whole = (part("n", 2) != "") & ~F.col("n").rlike(r"(^| )[a-z]( |\|)")
    counted = named.groupBy("n").agg(F.sum(F.when(F.col("src") == tidy_src, TIDY).otherwise(1.0)).alias("count"))
    spelled = counted.select("n", (F.col("count") * F.when(whole, 1.0).otherwise(SHORTENED)).alias("weight"))

    def keyed(codes, weights):
        for x in zip(codes, weights, strict=True):
            yield (*x, records.name_keys(x[0]))

    spelled = cut(map_rows(spelled, keyed, "id string, weight double, keys array<bigint>"), "spellings")
    # Spellings of one organisation can't differ in trade, as places can't in house.
    sides = spelled.select("id", "keys", part("id", 2).alias("house"))
    pairs = whole_pairs(sides, sides).filter(F.col("l") != F.col("r"))
    full = with_codes(pairs, spelled, spelled, ("weight",))
    # l is the variant and r the more frequent spelling.
    full = full.filter((F.col("weight_r") > F.col("weight_l")) | (F.col("weight_r") == F.col("weight_l")) & (F.col("r") < F.col("l")))

    def likely(ls, rs, wl, wr):
        for x, y, u, v in zip(ls, rs, wl, wr, strict=True):
            cost = records.name_cost(x, y)
            # Trades are left out in typing, not made up.
            if cost is None or cost >= 2 or records.split_code(x)[1] and not records.split_code(y)[1]:
                continue
            gain = math.log(v) - COST_WEIGHT * cost
            if gain > math.log(u) * 0.2 - COST_WEIGHT * OWN_NAME:
                yield x, y, gain

    scored = map_rows(full.select("l", "r", "weight_l", "weight_r"), likely, "l string, r string, gain double")
    up = scored.groupBy("l").agg(F.max(F.struct(F.col("gain"), F.col("r"))).alias("best")).select(F.col("l").alias("n"), F.col("best.r").alias("root"))
    links = cut(up, "links")
    # Each doubling halves the way to the end; ranks fall along a link, so there are no cycles.
    while True:
        nxt = links.select(F.col("n").alias("root"), F.col("root").alias("beyond"))
        links = cut(links.join(nxt, "root", "left").select("n", F.coalesce("beyond", "root").alias("root")), "links")
        if links.select("root").join(links.select(F.col("n").alias("root")), "root", "left_semi").isEmpty():
            break
    return spelled.select(F.col("id").alias("n")).join(links, "n", "left").select("n", F.coalesce("root", "n").alias("root"))


def same_name(parsed_rows: DataFrame, tidy_src: str, typed_src: str) -> DataFrame:
    """``(l, r)`` of records that carry one organisation's name."""
    roots = cut(attributed_spellings(parsed_rows, tidy_src, typed_src), "roots")
    named = parsed_rows.filter(F.col("n") != "").join(roots, "n")
    a = named.filter(F.col("src") == tidy_src).select("root", F.col("id").alias("l"))
    b = named.filter(F.col("src") == typed_src).select("root", F.col("id").alias("r"))
    return a.join(b, "root").select("l", "r")
