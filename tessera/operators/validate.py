"""Checks of result files, as a table of violations (rule, level, n, examples)."""

from __future__ import annotations

import argparse
import sys

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tessera.schema import CANDIDATE_HEADER, MATCH_HEADER
from tessera.sources.entities import numbered, read_ids

REPORT = "rule string, level string, n long, examples array<string>"


def read_lines(spark: SparkSession, path: str) -> DataFrame:
    """(line_no, value), lines from 0 in file order."""
    return numbered(spark.read.text(path), "line_no")


def parsed(lines: DataFrame) -> DataFrame:
    """(line_no, s1, ids, has_tab) of the non-blank lines below the header; list ids are not trimmed."""
    rows = lines.where((F.col("line_no") > 0) & (F.trim("value") != ""))
    cut = F.split("value", "\t", 2)
    return rows.select("line_no", F.trim(cut[0]).alias("s1"), F.filter(F.split(F.coalesce(F.get(cut, F.lit(1)), F.lit("")), ","), lambda x: x != "").alias("ids"), F.contains("value", F.lit("\t")).alias("has_tab"))


def _rule(rows: DataFrame, rule: str, level: str, example) -> DataFrame:
    found = rows.select(example.cast("string").alias("x"))
    top = found.distinct().orderBy("x").limit(5).agg(F.array_sort(F.collect_set("x")).alias("examples"))
    return found.agg(F.count(F.lit(1)).alias("n")).crossJoin(top).select(F.lit(rule).alias("rule"), F.lit(level).alias("level"), "n", "examples")


def list_violations(rows: DataFrame, required: DataFrame, valid_ids: DataFrame | None = None) -> DataFrame:
    """Violations of a parsed file; required has (id)."""
    rows, bad = rows.where("has_tab"), rows.where("not has_tab")
    each = rows.select("line_no", "s1", F.explode("ids").alias("id"))
    seen = rows.select(F.col("s1").alias("id")).distinct()
    out = [
        _rule(bad, "no tab", "error", F.col("line_no") + 1),
        _rule(rows.groupBy("s1").count().where("count > 1"), "duplicate query row", "error", F.col("s1")),
        _rule(rows.where(F.size("ids") != F.size(F.array_distinct("ids"))), "repeated id in a list", "error", F.col("s1")),
        _rule(each.where(F.col("id").startswith("S1-")), "query id in a list", "error", F.col("id")),
        _rule(each.where(~F.col("id").rlike("^S[123]-")), "id of no source", "error", F.col("id")),
        _rule(required.select("id").distinct().join(seen, "id", "left_anti"), "missing query row", "error", F.col("id")),
        _rule(seen.join(required.select("id").distinct(), "id", "left_anti"), "unknown query row", "error", F.col("id")),
    ]
    if valid_ids is not None:
        out.append(_rule(each.where(F.col("id").rlike("^S[23]-")).join(valid_ids.select("id").distinct(), "id", "left_anti"), "id not in the sources", "error", F.col("id")))
    total = out[0]
    for o in out[1:]:
        total = total.unionByName(o)
    return total.where("n > 0")


def not_candidates(matches: DataFrame, candidates: DataFrame) -> DataFrame:
    """(s1, extra): matched ids that are no candidates, parsed files."""
    c = candidates.select(F.col("s1"), F.col("ids").alias("candidates"))
    extra = F.array_except("ids", F.coalesce("candidates", F.array().cast("array<string>")))
    return matches.join(c, "s1", "left").select("s1", extra.alias("extra")).where(F.size("extra") > 0)


def counts(rows: DataFrame) -> DataFrame:
    rows = rows.where("has_tab")
    return rows.agg(F.count(F.lit(1)).alias("n_rows"), F.coalesce(F.sum((F.size("ids") == 0).cast("long")), F.lit(0)).alias("n_empty"))


def _readable(spark: SparkSession, path: str, header: tuple[str, str], name: str) -> tuple[list, DataFrame | None]:
    """Errors that stop the check of a file, or its lines."""
    fs_path = spark._jvm.org.apache.hadoop.fs.Path(path)
    fs = fs_path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(fs_path):
        return [(f"{name}: no file", "error", 1, [path])], None
    if spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1).count():
        return [(f"{name}: not UTF-8", "error", 1, [path])], None
    lines = read_lines(spark, path)
    first = lines.where("line_no = 0").first()
    if first is None:
        return [(f"{name}: empty", "error", 1, [path])], None
    value = first["value"].lstrip("﻿")
    if "\t" not in value and "," in value:
        return [(f"{name}: header has commas, no tab", "error", 1, [value])], None
    if tuple(x.strip().lower() for x in value.split("\t")) != header:
        return [(f"{name}: header", "error", 1, [value])], None
    return [], lines


def validate(spark: SparkSession, matches: str, candidates: str | None, sources: list[str], check_ids: bool = False) -> DataFrame:
    """All violations of the two result files against the source files (query side first); none: they pass."""
    required = read_ids(spark, sources[0])
    valid = None
    if check_ids:
        valid = read_ids(spark, sources[1])
        for s in sources[2:]:
            valid = valid.union(read_ids(spark, s))
    errors, lines = _readable(spark, matches, MATCH_HEADER, "matches")
    found = spark.createDataFrame(errors, REPORT)
    m = parsed(lines) if lines is not None else None
    if m is not None:
        found = found.unionByName(list_violations(m, required, valid))
    if candidates is None:
        return found.unionByName(spark.createDataFrame([("candidates: no file", "warning", 1, [])], REPORT))
    errors, lines = _readable(spark, candidates, CANDIDATE_HEADER, "candidates")
    missing = [(r, "warning" if r.endswith("no file") else level, n, x) for r, level, n, x in errors]
    found = found.unionByName(spark.createDataFrame(missing, REPORT))
    if lines is not None:
        c = parsed(lines)
        found = found.unionByName(list_violations(c, required, valid).withColumn("rule", F.concat(F.lit("candidates: "), "rule")))
        if m is not None:
            found = found.unionByName(_rule(not_candidates(m.where("has_tab"), c.where("has_tab")), "matches not among candidates", "warning", F.col("s1")).where("n > 0"))
    return found


def main(arguments: list[str] | None = None) -> int:
    """The check as a command; the exit code is 0 if nothing stands against the files."""
    p = argparse.ArgumentParser(description="Checks result files against the source files.")
    p.add_argument("-m", "--matching", default="output/matching_results.tsv")
    p.add_argument("-c", "--candidate", default="output/candidate_pairs.tsv")
    p.add_argument("-t", "--test-dir", default="student_resource/dataset/test", help="folder of test_source1.tsv to test_source3.tsv")
    p.add_argument("--check-ids", action="store_true", help="listed ids must exist in the target sources")
    a = p.parse_args(arguments)
    spark = SparkSession.builder.getOrCreate()
    try:
        found = validate(spark, a.matching, a.candidate, [f"{a.test_dir}/test_source{k}.tsv" for k in (1, 2, 3)], a.check_ids).collect()
    except AnalysisException as e:
        print(f"FAIL: {e}")
        return 1
    for r in sorted(found, key=lambda r: (r["level"], r["rule"])):
        print(f"{r['level']}: {r['rule']}: {r['n']} ({', '.join(map(str, r['examples']))})")
    bad = any(r["level"] == "error" for r in found)
    print("FAIL" if bad else "PASS")
    return int(bad)


def passed(violations: DataFrame) -> bool:
    return violations.where("level = 'error'").limit(1).count() == 0


if __name__ == "__main__":
    sys.exit(main())
