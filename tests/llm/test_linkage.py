import random

import pytest
from pyspark.sql import functions as F

from tallyweave.llm import linkage, overlap, records
from tallyweave.llm.vocabulary import learn

TABLE = "entity_id string, business_name string, business_address string, country string, keys string"


VOCABULARY = records.Vocabulary.of(
    {"foods": "foods", "fds": "foods", "manufacturing": "mfg", "mfg": "mfg", "engineering": "engg", "engg": "engg", "bakery": "bakery", "salon": "salon", "sln": "salon", "motors": "motors"},
    {"royal": "royal"},
    ["kerala", "uttar", "pradesh", "water", "tank", "new", "mexico"],
)


def name_code(text):
    return records.name_code(text, VOCABULARY)


def address_code(text):
    return records.address_code(text, VOCABULARY)


def parsed(tables, *more):
    return linkage.parsed(tables, *more, vocabulary=VOCABULARY)


def table(spark, rows):
    return spark.createDataFrame([(*r, "clash") for r in rows], TABLE)


def test_names():
    code = name_code
    assert code("Nasinek Tithutre Manufacturing Pvt. Ltd.") == code("nasinek tithutre mfg")
    assert records.name_cost(code("Royal Kunifik Fejalan Engineering"), code("KUNIFIK FEJALAN ENGG. GROUP")) < 0.3
    assert records.name_cost(code("Tithutre, Nasinek Foods"), code("Nasinek Tithutre Fds")) < 0.5
    assert records.name_cost(code("Moche Gekisi Foods No. 8"), code("Moche Gekisi Foods No. 9")) == 9.0
    assert records.name_cost(code("Moche Gekisi Foods"), code("Moche Gekisi Bakery")) == 9.0
    assert records.name_cost(code("Moche Gekisi Foods"), code("Vashira Shethazo Foods")) >= 1.3
    for missing in (None, "", " ", "N/A", "--", "unknown", "na"):
        assert code(missing) == "" and address_code(missing) == ""
    assert code("x" * 20_000) and code("!!!") == "" and code("M/s") == ""


def test_addresses():
    parse = lambda t: records.parse_address(t, VOCABULARY)
    assert parse("115 Drosuld Lukunu Pkwy; Near water tank; Pefiville; 28459") == ("115", ["drosuld", "lukunu"], "pefivile", "28459", "")
    assert parse("Shop No 10, 13, Gobrick Brawegre Road, Lalugaon - 447495, Uttar Pradesh")[:5] == ("13", ["gobrik", "bravegre"], "lalugaon", "447495", "10")
    assert parse("Uttar Pradesh Stopiabad 854 444 245/ Tafess Lugragri Colony")[:4] == ("245", ["tafes", "lugragri"], "stopiabad", "854444")
    same = records.address_evidence
    a, b = address_code("43 Ckustuw Wedike Ct, Setrufield, NM 96446"), address_code("NEW MEXICO 96446, Setrfuield, 43 Clustuw Wedike")
    assert same(a, b)[0] > 3
    assert same(a, address_code("44 Ckustuw Wedike Ct, Setrufield, NM 96446"))[0] < 0
    assert same(a, address_code("43 Ckustuw Wedike Ct, Pefiville, OH 11111"))[0] < 0


def test_edits():
    rng = random.Random(7)

    def full(a, b):
        d = {}
        for i in range(len(a) + 1):
            for j in range(len(b) + 1):
                d[i, j] = i + j if not i or not j else min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
                if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                    d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
        return d[len(a), len(b)]

    for _ in range(3000):
        a, b = ("".join(rng.choice("abcd") for _ in range(rng.randrange(7))) for _ in range(2))
        assert records.edits(a, b, 4) == min(4, full(a, b)) and records.within_one(a, b) == (full(a, b) <= 1)


LEFT = [
    ("S1-1", "Moche Gekisi Foods", "4 Wibo Stenu Road, Lalugaon - 447495, Kerala", "India"),
    ("S1-2", "Moche Gekisi Foods", "77 Drosa Lukun Lane, Stopiabad - 854444, Kerala", "India"),
    ("S1-3", "Vashira Shethazo Salon", "4 Wibo Stenu Road, Lalugaon - 447495, Kerala", ""),
    ("S1-3", "Vashira Shethazo Salon", "4 Wibo Stenu Road, Lalugaon - 447495, Kerala", ""),
    ("S1-4", None, None, None),
    ("S1-5", "", "N/A", "US"),
]
RIGHT = [
    ("S2-1", "moche gekissi fds ltd", "no. 4 wibo stenu rd; lalugaon 447495", "IN"),
    ("S2-2", "Gekisi Moche", "77 Drosa Lukun Ln Stopiabad", None),
    ("S2-3", "Shetazo Vashira Sln", "Kerala, 4/ Wibo Stennu Rd, Lalugaon", "India"),
    ("S2-4", "Nobody Elsehere Motors", "9 Otherwise Placehere St, Pefiville", "US"),
    ("S2-5", None, "unknown", "US"),
    ("S2-6", "Moche Gekisi Bakery", "4 Wibo Stenu Road, Lalugaon - 447495", "India"),
]


def test_beliefs(spark):
    rows = parsed({"a": table(spark, LEFT), "b": table(spark, RIGHT)}, linkage.belief_keys("a"))
    sizes = [0.2, 0.25, 0.25, 0.15, 0.08, 0.04, 0.02, 0.01]
    got = {(r.l, r.r): r.probability for r in linkage.belief_matches(rows, "a", ["b"], sizes).collect()}
    assert {k for k, p in got.items() if p >= 0.5} == {("S1-1", "S2-1"), ("S1-2", "S2-2"), ("S1-3", "S2-3")}
    by_right = {}
    for (_, r), p in got.items():
        by_right[r] = by_right.get(r, 0) + p
    assert all(p <= 1 + 1e-9 for p in by_right.values())
    empty = parsed({"a": table(spark, LEFT[:0] or []), "b": table(spark, RIGHT)}, linkage.belief_keys("a")) if LEFT else None
    assert linkage.belief_matches(empty, "a", ["b"], sizes).count() == 0


def test_capacity(spark):
    df = spark.createDataFrame([("a", "x,y"), ("b", ""), ("c", None), ("d", "x")], "source1_entity_id string, matched_entity_ids string")
    sizes = linkage.capacity(df)
    assert len(sizes) == 8 and sum(sizes) == pytest.approx(1) and sizes[0] > sizes[1] > sizes[3]


def test_same_address(spark):
    rows = parsed({"a": table(spark, LEFT), "b": table(spark, RIGHT)})
    got = {(r.l, r.r) for r in linkage.same_address(rows, "a", "b").collect()}
    assert got == {("S1-1", "S2-1"), ("S1-1", "S2-3"), ("S1-1", "S2-6"), ("S1-3", "S2-1"), ("S1-3", "S2-3"), ("S1-3", "S2-6"), ("S1-2", "S2-2")}


def test_missing_house_needs_one_house(spark):
    left = [("S1-1", "A", "4 Wibo Stenu Road, Lalugaon", ""), ("S1-2", "B", "5 Wibo Stenu Road, Lalugaon", ""), ("S1-3", "C", "9 Drosa Lukun Lane, Stopiabad", "")]
    right = [("S2-1", "A", "Wibo Stenu Road, Lalugaon", ""), ("S2-2", "C", "Drosa Lukun Lane, Stopiabad", "")]
    rows = parsed({"a": table(spark, left), "b": table(spark, right)})
    assert {(r.l, r.r) for r in linkage.same_address(rows, "a", "b").collect()} == {("S1-3", "S2-2")}


def test_same_name(spark):
    rows = parsed({"a": table(spark, LEFT), "b": table(spark, RIGHT)})
    got = {(r.l, r.r) for r in linkage.same_name(rows, "a", "b").collect()}
    assert got == {("S1-1", "S2-1"), ("S1-2", "S2-1"), ("S1-1", "S2-2"), ("S1-2", "S2-2"), ("S1-3", "S2-3")}


def test_overlap_finds_what_brute_force_finds(spark):
    rng = random.Random(9)
    syllable = lambda: rng.choice("bdfgklmnprstvz") + rng.choice("aeiou")
    word = lambda: "".join(syllable() for _ in range(3))
    train = [(f"S1-{k:03d}", f"{word()} {word()} Foods", f"{k} {word()} {word()} Road, {word()}ton - 44{k:04d}", "India") for k in range(120)]
    test = [(f"S1-5{k:02d}", n.upper(), a.replace("Road", "Rd"), c) for k, (_, n, a, c) in enumerate(train[:30])]
    test += [(f"S1-6{k:02d}", n, f"{k + 500} {word()} {word()} Road, {word()}ton", c) for k, (_, n, _, c) in enumerate(train[:30])]
    test += [("S1-700", None, None, None), ("S1-701", train[5][1], train[5][2], "India")]
    splits = {"one": ("tr", "te")}
    rows = parsed({"tr": table(spark, train), "te": table(spark, test)})
    pairs = overlap.overlaps(rows, splits)
    got = {(r.train_id, r.eval_id) for r in pairs.collect()}
    code = lambda r: (name_code(r[1]), address_code(r[2]))
    want = {(a[0], b[0]) for a in train for b in test if overlap.same_record(*code(a), *code(b))}
    assert got == want and len(want) == 31
    counted = overlap.overlap_counts(pairs, splits).first()
    assert (counted.pairs, counted.eval_records) == (31, 31)


def test_scanner_with_common_passages():
    texts = [(f"e{k}", f"alpha beta{'x' * (k // 100)}|1||", "5|gamma delta|town|12345|") for k in range(200)]
    scanner = overlap.Scanner(texts)
    found = dict(scanner.scan(overlap.normal_text("alpha beta|1||", "5|gamma delta|town|12345|")))
    assert len(found) == 200 and found[0] == pytest.approx(1.0)


def test_overlap_with_hot_names_and_streets(spark):
    rng = random.Random(4)
    syllable = lambda: rng.choice("bdfgklmnprstvz") + rng.choice("aeiou")
    word = lambda: "".join(syllable() for _ in range(3))
    towns = [f"{word()}ton" for _ in range(90)]
    # One chain everywhere, and one street with many other names.
    test = [(f"S1-1{k:03d}", "Vashira Shethazo Foods", f"{k + 1} {word()} Road, {towns[k]}", "India") for k in range(90)]
    test += [(f"S1-2{k:03d}", f"Vashira {word()} Foods", f"Wibostenu Road, {towns[k]}", "India") for k in range(90)]
    test += [("S1-3000", "Vashira Shethazo Foods", None, "India"), ("S1-3001", "Vashira Gekisi Foods", "Wibostenu Road, Lalugaon", "India")]
    train = [("S1-0000", "Vashira Shethazo Foods", "", "India"), ("S1-0001", "Vashira Shethazzo Foods", None, "India"), ("S1-0002", "Vashira Geksi Foods", "12 Wibostenu Road, Lalugaon", "India")]
    train += [(f"S1-01{k:02d}", n, a, c) for k, (_, n, a, c) in enumerate(test[:20])]
    rows = parsed({"tr": table(spark, train), "te": table(spark, test)})
    got = {(r.train_id, r.eval_id) for r in overlap.overlaps(rows, {"one": ("tr", "te")}).collect()}
    code = lambda r: (name_code(r[1] or ""), address_code(r[2] or ""))
    want = {(a[0], b[0]) for a in train for b in test if overlap.same_record(*code(a), *code(b))}
    assert got == want and {("S1-0000", "S1-3000"), ("S1-0001", "S1-3000"), ("S1-0002", "S1-3001")} <= got


def test_whole_keys_in_parts(spark):
    rng = random.Random(6)
    rows = lambda side: [(f"{side}{k}", [1, 10 + k % 9], rng.choice([None, "", "4", "5", "6"])) for k in range(60)]
    one, two = rows("l"), rows("r")
    schema = "id string, keys array<bigint>, house string"
    left, right = overlap.whole_keys(spark.createDataFrame(one, schema), spark.createDataFrame(two, schema), 20, 7, 5)
    got = {(x.l, x.r) for x in left.select("key", F.col("id").alias("l")).join(right.select("key", F.col("id").alias("r")), "key").collect()}
    able = lambda g, h: (g is None) == (h is None) and (g == h or "" in (g, h))
    assert got == {(a, b) for a, x, g in one for b, y, h in two if able(g, h) or set(x[1:]) & set(y[1:])}


def test_scanner_proposes_by_common_passages_beside_a_rare_one():
    texts = [(f"e{k}", f"hotword {'abcdefghij'[k // 10]}{'klmnopqrst'[k % 10]}own|1||", "|hot street|town|12345|") for k in range(100)]
    scanner = overlap.Scanner([*texts, ("typo", "hotword gutpa|1||", "|hot street|town||")])
    assert 100 in dict(scanner.scan(overlap.normal_text("hotword gupta|1||", "12|hot street||||")))


def test_same_address_on_a_hot_street(spark):
    letters = "abcdefghij"
    others = [(f"{s}-1{k:03d}", "A", f"{k + 20} Wibostenu Road, Town{letters[k // 10]}{letters[k % 10]}ville - {400000 + 137 * k}", "") for s in ("S1", "S2") for k in range(90)]
    left = [x for x in others if x[0][:2] == "S1"] + [("S1-2", "B", "12 Wibostenu Road, Lalugaon - 447495", "")]
    right = [x for x in others if x[0][:2] == "S2"] + [("S2-2", "C", "12 Wibostenu Road", "")]
    got = {(r.l, r.r) for r in linkage.same_address(parsed({"a": table(spark, left), "b": table(spark, right)}), "a", "b").collect()}
    code = lambda r: address_code(r[2])
    want = {(x[0], y[0]) for x in left for y in right if linkage.same_place(code(x), code(y)) is not None}
    assert got == want and ("S1-2", "S2-2") in got


def test_hot_words_of_names(spark):
    letters = "bdfgklmnpr"
    names = [f"Z{letters[k // 10]}a{letters[k % 10]}ovi" for k in range(90)]
    left = [(f"S1-1{k:03d}", f"{x} Hotwordo Foods", f"{k + 20} {x} Road", "") for k, x in enumerate(names)]
    left += [(f"S1-2{k:03d}", "Kavita Hotwordo Foods", f"{k + 200} Wibostenu Road", "") for k in range(90)]
    right = [("S2-1", "K. Hotwordo Foods", "", ""), ("S2-2", "Kavita Hotwordo Foods", "Town Gekisiville", "")]
    rows = parsed({"a": table(spark, left), "b": table(spark, right)})
    n = name_code
    roots = {r.n: r.root for r in linkage.attributed_spellings(rows, "a", "b").collect()}
    assert roots[n("K. Hotwordo Foods")] == n("Kavita Hotwordo Foods")


def test_beliefs_of_a_hot_organisation(spark):
    left = [(f"S1-2{k:03d}", "Kavita Hotwordo Foods", f"{k + 200} Drosa Lukun Lane, Stopiabad - 854444", "") for k in range(90)]
    left += [("S1-3", "Kavita Hotwordo Foods", "4 Wibostenu Gekisi Road, Lalugaon - 447495", "India")]
    right = [("S2-1", "Kavita Hotwordo Foods", "Wibosteku Gekisi Road, Lalugaon - 447495", "India")]
    rows = parsed({"a": table(spark, left), "b": table(spark, right)}, linkage.belief_keys("a"))
    got = {(r.l, r.r) for r in linkage.belief_matches(rows, "a", ["b"], [0.3, 0.4, 0.2, 0.1]).filter("probability >= 0.5").collect()}
    assert got == {("S1-3", "S2-1")}


def test_messages_change_the_winner(spark):
    # l1 has four sure matches and is the likelier owner of r0 by itself; l2 has none.
    rows = [("l1", "r0", 2.0), ("l2", "r0", 1.7)] + [("l1", f"r{k}", 6.0) for k in range(1, 5)] + [("l3", "r9", 1.0)]
    edges = spark.createDataFrame(rows, "l string, r string, w double")
    got = {(r.l, r.r): r.probability for r in linkage.propagated(edges, [0.0, -0.5, -1.0, -2.0, -3.0]).collect()}
    assert len(got) == len(rows) and got["l2", "r0"] > 0.5 > got["l1", "r0"]
    assert got["l1", "r0"] + got["l2", "r0"] <= 1 and got["l3", "r9"] == pytest.approx(0.7310586)
    still = {(r.l, r.r): r.probability for r in linkage.propagated(edges, [0.0] * 5).collect()}
    assert still["l1", "r0"] > still["l2", "r0"]
    assert linkage.propagated(edges.limit(0), [0.0, -1.0]).count() == 0


def test_learnt_words(spark):
    rng = random.Random(11)
    syllable = lambda: rng.choice("bdfgklmnprstvz") + rng.choice("aeiou")
    word = lambda: "".join(syllable() for _ in range(4))
    trades, rows = [("Sdoof", "Sdf"), ("Gnitnirp Sserp", "Gtrp Sserp"), ("Yrekab", "Bkry"), ("Efac", None)], []
    for k in range(400):
        own, (long, short), given = f"{word()} {word()}", trades[k % 4], ("Mailliw", "Llib") if k % 5 == 0 else ("", "")
        town = f"{'xyz'[k % 3]}ton"
        place = lambda n: f"{n} {word()} Road, Raen Knat, {town}, {10 + k % 3}{rng.randrange(1000):03d}"  # noqa: E731, B023
        for n in range(3):
            name = f"{given[n > 1]} {own} {long if n == 0 or not short or rng.random() < 0.4 else short} {rng.choice(['Ltd', 'Inc', ''])}"
            rows.append((f"S1-{k}-{n}", name.strip(), place(k + 1), "India"))
    rows += [("S1-null", None, None, None), ("S1-empty", "", "", "")]
    learnt = learn([table(spark, rows)])
    of = learnt.trades
    assert of["sdoof"] == of["sdf"] and of["yrekab"] == of["bkry"] and of["gnitnirp"] == of["gtrp"] == of["sserp"] and "efac" in of
    assert len({of[w] for w in ("sdoof", "yrekab", "sserp", "efac")}) == 4 and "ltd" not in of
    assert learnt.givens["mailliw"] == learnt.givens["llib"] and not set(learnt.givens) & set(of)
    assert "knat" in learnt.other and not {"xton", "yton"} & learnt.other
    none = learn([table(spark, rows).limit(0)])
    assert not none.trades and not none.givens


def test_letters_of_streets_keep_all_near_ones(spark):
    """most records of one house number and town are on other streets, and end before any text is compared."""
    rng = random.Random(11)
    word = lambda: "".join(rng.choice("bdfgklmnprst") + rng.choice("aeio") for _ in range(rng.choice((1, 2, 3, 3, 4, 5))))
    streets = [" ".join(word() for _ in range(rng.choice((1, 2, 2, 3)))) for _ in range(150)]
    for street in list(streets):
        ws = [list(w) for w in street.split()]
        for _ in range(rng.choice((1, 2, 3))):
            w = rng.choice(ws)
            at = rng.randrange(len(w))
            if rng.random() < 0.3 and at:
                w[at - 1], w[at] = w[at], w[at - 1]
            elif rng.random() < 0.5 and len(w) > 1:
                del w[at]
            else:
                w.insert(at, rng.choice("bdk"))
        rng.shuffle(ws)
        streets.append(rng.choice((" ", "")).join(map("".join, ws)))
    streets += ["k lapo", "kapo lapo"]
    rows = [(s, *linkage.street_letters(f"1|{s}|town||")) for s in dict.fromkeys(streets)]
    df = spark.createDataFrame(rows, "street string, joined string, turned string, letters bigint, reach int")
    side = lambda c: df.select(F.struct("street", "joined", "turned", "letters", "reach").alias(c))
    kept = {tuple(x) for x in side("l").crossJoin(side("r")).filter(linkage._maybe_one_street()).select("l.street", "r.street").collect()}
    want = {(a, b) for a, *_ in rows for b, *_ in rows if records.words_cost(a, b) < 1 and not {w for w in a.split() if len(w) > 2} & set(b.split())}
    assert want and want <= kept and len(kept) < 0.3 * len(rows) ** 2
