"""Command line of the validator: exit code 0 if the files pass, else 1."""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from tallyweave.operators.validate import validate


def main(arguments: list[str] | None = None) -> int:
    p = argparse.ArgumentParser(description=__doc__)
    p.add_argument("-m", "--matching", required=True)
    p.add_argument("-c", "--candidate")
    p.add_argument("-t", "--test-dir", required=True)
    p.add_argument("--check-ids", action="store_true")
    a = p.parse_args(arguments)
    report = validate(SparkSession.builder.appName("tallyweave-check").getOrCreate(), a.matching, a.candidate, a.test_dir, a.check_ids)
    print(report.text())
    return 0 if report.ok else 1


if __name__ == "__main__":
    sys.exit(main())
