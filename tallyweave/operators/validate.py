"""Rules for files of id lists."""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyweave.sources.records import _lines, exists, load_match_targets, read_ids

MATCHING_HEADER = ("source1_entity_id", "matched_entity_ids")
CANDIDATE_HEADER = ("source1_entity_id", "candidate_entity_ids")
EXAMPLES = 5


@dataclass
class Report:
    """Messages of a validation; ``ok`` without errors."""

    errors: list[str] = field(default_factory=list)
    warnings: list[str] = field(default_factory=list)

    @property
    def ok(self) -> bool:
        return not self.errors

    def text(self) -> str:
        lines = [f"{'PASS' if self.ok else 'FAIL'}: {len(self.errors)} errors, {len(self.warnings)} warnings"]
        return "\n".join(lines + [f"{k}. {m}" for k, m in enumerate(self.errors, 1)] + [f"warning: {m}" for m in self.warnings])


def parsed_lines(lines: DataFrame) -> DataFrame:
    """``(line, ok, s1_id, ids)`` of numbered text lines below the header; a line without a tab is not ok, blank ones are left out."""
    body = lines.filter((F.col("line") > 1) & (F.trim("value") != ""))
    rest = F.regexp_extract("value", r"^[^\t]*\t(.*)$", 1)
    ids = F.when(F.trim(rest) == "", F.array().cast("array<string>")).otherwise(F.split(rest, ","))
    return body.select("line", F.col("value").contains("\t").alias("ok"), F.trim(F.split_part("value", F.lit("\t"), F.lit(1))).alias("s1_id"), ids.alias("ids"))


def last_lists(rows: DataFrame) -> DataFrame:
    """``(s1_id, ids)``: a repeated record counts with its last line."""
    return rows.filter("ok").groupBy("s1_id").agg(F.max_by("ids", "line").alias("ids"))


def broken_rules(rows: DataFrame, required: DataFrame, known: DataFrame | None = None) -> DataFrame:
    """``(rule, offender)`` of parsed lines.

    Rules: malformed line, repeated record, repeated id in a list, an id of
    Source 1 in a list, an id of no source, an unknown id (if ``known`` ids are
    given), a required record that is missing, a record that is not required.
    """
    rule = lambda name, c: F.struct(F.lit(name).alias("rule"), c.cast("string").alias("offender"))
    good = rows.filter("ok")
    ids = good.select("s1_id", F.explode("ids").alias("id"))
    seen = good.select("s1_id").distinct()
    own = F.col("id").startswith("S1-")
    found = [
        rows.filter("not ok").select(rule("malformed_line", F.col("line")).alias("x")),
        good.groupBy("s1_id").count().filter("count > 1").select(rule("repeated_record", F.col("s1_id")).alias("x")),
        good.filter(F.size("ids") != F.size(F.array_distinct("ids"))).select(rule("repeated_id", F.col("s1_id")).alias("x")),
        ids.filter(own).select(rule("source1_id", F.col("id")).alias("x")),
        ids.filter(~own & ~F.col("id").rlike("^S[23]-")).select(rule("wrong_prefix", F.col("id")).alias("x")),
        required.join(seen, "s1_id", "left_anti").select(rule("missing_record", F.col("s1_id")).alias("x")),
        seen.join(required, "s1_id", "left_anti").select(rule("extra_record", F.col("s1_id")).alias("x")),
    ]
    if known is not None:
        unknown = ids.filter(F.col("id").rlike("^S[23]-")).join(known, "id", "left_anti")
        found.append(unknown.select(rule("unknown_id", F.col("id")).alias("x")))
    out = found[0]
    for more in found[1:]:
        out = out.union(more)
    return out.select("x.*").distinct()


def outside_candidates(matching: DataFrame, candidates: DataFrame) -> DataFrame:
    """Records ``s1_id`` with a match that is none of their candidates; both sides ``(s1_id, ids)``."""
    pairs = lambda d: d.select("s1_id", F.explode("ids").alias("id")).distinct()
    return pairs(matching).join(pairs(candidates), ["s1_id", "id"], "left_anti").select("s1_id").distinct()


def summary(found: DataFrame) -> DataFrame:
    """``(rule, n, examples)``: distinct offenders of each rule and the first five in order; no rule's offenders are gathered."""
    from pyspark.sql.window import Window

    top = found.withColumn("at", F.row_number().over(Window.partitionBy("rule").orderBy("offender"))).filter(F.col("at") <= EXAMPLES)
    counts = found.groupBy("rule").agg(F.count("*").alias("n"))
    return counts.join(top.groupBy("rule").agg(F.array_join(F.array_sort(F.collect_list("offender")), ",").alias("examples")), "rule")


def _is_utf8(spark: SparkSession, path: str) -> bool:
    """Whether every line is UTF-8: lines are read in a byte encoding, so no file is held whole."""
    lines = spark.read.option("encoding", "ISO-8859-1").option("lineSep", "\n").csv(path, schema="value string", sep="\u0001", quote="", escape="", header=False)
    return lines.filter(~F.is_valid_utf8(F.encode("value", "ISO-8859-1").cast("string"))).isEmpty()


def validate_file(spark: SparkSession, path: str, header: tuple[str, str], required: DataFrame, known: DataFrame | None, report: Report) -> DataFrame | None:
    """Check one file of id lists; its lists ``(s1_id, ids)``, or None where it can't be read."""
    if not exists(spark, path):
        report.errors.append(f"{path} is missing")
        return None
    if not _is_utf8(spark, path):
        report.errors.append(f"{path} is not UTF-8")
        return None
    lines = _lines(spark, path)
    first = lines.filter("line = 1").select("value").first()
    if first is None:
        report.errors.append(f"{path} is empty")
        return None
    if "\t" not in first.value and "," in first.value:
        report.errors.append(f"{path} is separated by commas, not tabs")
        return None
    if tuple(c.strip().lower() for c in first.value.lstrip("﻿").split("\t")) != header:
        report.errors.append(f"{path} has the header {first.value!r}")
        return None
    rows = parsed_lines(lines)
    for r in summary(broken_rules(rows, required, known)).orderBy("rule").collect():  # one row a rule
        report.errors.append(f"{path}: {r.rule}: {r.n} ({r.examples.replace(',', ', ')})")
    return last_lists(rows)


def validate(spark: SparkSession, matching: str, candidates: str | None, folder: str, check_ids: bool = False) -> Report:
    """Check a file of matches and one of candidates against the test tables in ``folder``."""
    report = Report()
    source1 = f"{folder}/test_source1.tsv"
    if not exists(spark, source1):
        report.errors.append(f"{source1} is missing")
        return report
    required = read_ids(spark, source1).select(F.col("id").alias("s1_id"))
    known = None
    if check_ids:
        known, warnings = load_match_targets(spark, folder)
        report.warnings += warnings
    else:
        report.warnings.append("ids were not checked against the sources")
    found = validate_file(spark, matching, MATCHING_HEADER, required, known, report)
    if candidates is None or not exists(spark, candidates):
        report.warnings.append("no file of candidates")
        return report
    allowed = validate_file(spark, candidates, CANDIDATE_HEADER, required, known, report)
    if found is not None and allowed is not None:
        outside = outside_candidates(found, allowed)
        n = outside.count()
        if n:
            names = [r.s1_id for r in outside.orderBy("s1_id").limit(EXAMPLES).collect()]
            report.warnings.append(f"{n} records have matches outside their candidates ({', '.join(names)})")
    return report


