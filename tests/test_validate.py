from tallyweave.operators.validate import validate
from tallyweave.sources import records as io


def write(path, text):
    path.write_text(text, encoding="utf-8")
    return str(path)


HEAD = "entity_id\tbusiness_name\tbusiness_address\tcountry\n"
MATCH, CAND = "source1_entity_id\tmatched_entity_ids\n", "source1_entity_id\tcandidate_entity_ids\n"


def setup(tmp_path):
    write(tmp_path / "test_source1.tsv", HEAD + "S1-1\ta\tb\tUS\nS1-2\ta\tb\tUS\n")
    write(tmp_path / "test_source2.tsv", HEAD + "S2-1\ta\tb\tUS\n")
    write(tmp_path / "test_source3.tsv", HEAD + "S3-1\ta\tb\tUS\n")
    return write(tmp_path / "cand.tsv", CAND + "S1-1\tS2-1,S3-1\nS1-2\t\n")


def errors(spark, tmp_path, text, **options):
    cand = setup(tmp_path)
    return validate(spark, write(tmp_path / "match.tsv", text), cand, str(tmp_path), **options)


def test_good_file(spark, tmp_path):
    report = errors(spark, tmp_path, MATCH + "S1-1\tS2-1\nS1-2\t\n", check_ids=True)
    assert report.ok and not report.warnings and report.text().startswith("PASS")


def test_each_rule(spark, tmp_path):
    bad = {
        "": "empty",
        "source1_entity_id,matched_entity_ids\n": "commas",
        "a\tb\n": "header",
        MATCH + "S1-1\tS2-1\nS1-2\nS1-2\t\n": "malformed_line",
        MATCH + "S1-1\tS2-1\nS1-1\tS2-1\nS1-2\t\n": "repeated_record",
        MATCH + "S1-1\tS2-1,S2-1\nS1-2\t\n": "repeated_id",
        MATCH + "S1-1\tS1-2\nS1-2\t\n": "source1_id",
        MATCH + "S1-1\tS2-1,\nS1-2\t\n": "wrong_prefix",
        MATCH + "S1-1\tS2-77\nS1-2\t\n": "unknown_id",
        MATCH + "S1-1\tS2-1\n": "missing_record",
        MATCH + "S1-1\tS2-1\nS1-2\t\nS1-3\t\n": "extra_record",
    }
    for text, word in bad.items():
        report = errors(spark, tmp_path, text, check_ids=True)
        assert not report.ok and any(word in e for e in report.errors), (word, report.errors)


def test_warnings_and_missing(spark, tmp_path):
    report = errors(spark, tmp_path, MATCH + "S1-1\tS2-1\nS1-2\tS2-1\n")
    assert report.ok and any("S1-2" in w for w in report.warnings)
    cand = str(tmp_path / "cand.tsv")
    assert not validate(spark, str(tmp_path / "none.tsv"), cand, str(tmp_path)).ok
    (tmp_path / "raw.tsv").write_bytes(MATCH.encode() + b"S1-1\t\xff\xfe\n")
    assert any("UTF-8" in e for e in validate(spark, str(tmp_path / "raw.tsv"), cand, str(tmp_path)).errors)
    assert not validate(spark, cand, cand, str(tmp_path / "nowhere")).ok


def test_readers(spark, tmp_path):
    path = write(tmp_path / "s.tsv", HEAD + 'S1-1\t" ""A"" & B "\tNA\t\nS1-2\tnull\t\tUS\n')
    rows = {r.entity_id: r for r in io.load_source_tsv(spark, path).collect()}
    assert rows["S1-1"].business_name == '"A" & B' and rows["S1-1"].business_address == "NA" and rows["S1-1"].country == ""
    assert rows["S1-2"].business_name == "null" and rows["S1-2"].business_address == ""
    truth = write(tmp_path / "t.tsv", MATCH + "S1-1\tS2-1, S3-1,,\nS1-2\t\n")
    got = {r.source1_entity_id: r.targets for r in io.load_ground_truth(spark, truth).collect()}
    assert got == {"S1-1": ["S2-1", "S3-1"], "S1-2": []}


def test_export(spark, tmp_path):
    left = spark.createDataFrame([("S1-2",), ("S1-1",)], "entity_id string")
    pairs = spark.createDataFrame([("S1-1", "S3-1"), ("S1-1", "S2-1"), ("S1-1", "S2-1")], "s1_id string, cand_id string")
    path = tmp_path / "out" / "m.tsv"
    io.export_id_lists(io.id_lists(pairs, left, "matched_entity_ids"), str(path))
    assert path.read_text() == MATCH + "S1-1\tS2-1,S3-1\nS1-2\t\n"
