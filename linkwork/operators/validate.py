"""Checks of results, each one aggregate or anti-join; violations are rows (rule, n, examples)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

RESULT_COLUMNS = ["source1_entity_id", "candidate_source", "candidate_record_id"]


def examples(c):
    return F.slice(F.array_sort(F.collect_set(c)), 1, 5)


def _rule(df: DataFrame, rule: str, column: str) -> DataFrame:
    return df.select(F.col(column).cast("string").alias("x")).agg(F.lit(rule).alias("rule"), F.count_distinct("x").alias("n"), F.array_join(examples("x"), ",").alias("examples")).where("n > 0")


def _all(rules: list[DataFrame]) -> DataFrame:
    out = rules[0]
    for r in rules[1:]:
        out = out.unionByName(r)
    return out


def validate_long(results: DataFrame, candidates: DataFrame, ids: DataFrame) -> DataFrame:
    """Violations of a long result: uncovered entities, repeated rows, matches that are no candidates, unknown sources."""
    if missing := [c for c in RESULT_COLUMNS if c not in results.columns]:
        raise ValueError(f"missing columns: {missing}")
    key = "source1_entity_id"
    match = results.where("candidate_source <> 'NONE'")
    pairs = candidates.select(F.col("s1").alias(key), F.col("rid").alias("candidate_record_id")).distinct()
    return _all([
        _rule(ids.select(key).distinct().join(results.select(key), key, "left_anti"), "uncovered", key),
        _rule(results.groupBy(*RESULT_COLUMNS).count().where("count > 1"), "duplicate", key),
        _rule(match.join(pairs, [key, "candidate_record_id"], "left_anti"), "not_a_candidate", key),
        _rule(results.where(~F.coalesce(F.col("candidate_source").isin("S2", "S3", "NONE"), F.lit(False))).withColumn("s", F.coalesce("candidate_source", F.lit("null"))), "bad_source", "s"),
    ])


def parse_header(header: str, expected: list[str]) -> list[str]:
    """Problems of a header line; none if it fits."""
    if not header:
        return ["empty"]
    if "\t" not in header and "," in header:
        return ["comma separated; tabs are needed"]
    found = [c.strip().lower() for c in header.rstrip("\n").split("\t")]
    return [] if found == expected else [f"unexpected header {found}"]


def validate_lists(lines: DataFrame, ids: DataFrame, known: DataFrame | None = None, prefixes=("S1-", "S2-", "S3-")) -> DataFrame:
    """Violations of a list result given as lines (line: s1 TAB comma-joined ids), without its header.

    ``known`` (id), if given, are the ids that may occur.
    """
    own, two, three = prefixes
    malformed = lines.where(~F.contains("line", F.lit("\t")) & (F.trim("line") != ""))
    rows = lines.where(F.contains("line", F.lit("\t"))).select(F.substring_index("line", "\t", 1).alias("s1"), F.expr("substring(line, instr(line, '\t') + 1)").alias("rest"))
    full = rows.where(F.trim("rest") != "")
    listed = full.select("s1", F.split("rest", ",").alias("ids"))
    one = listed.select("s1", F.explode(F.array_distinct("ids")).alias("id"))
    other = one.where(~F.startswith("id", F.lit(own)))
    fits = F.startswith(F.col("id"), F.lit(two)) | F.startswith(F.col("id"), F.lit(three))
    must = ids.select(F.col(ids.columns[0]).alias("s1")).distinct()
    rules = [
        _rule(malformed, "malformed", "line"),
        _rule(rows.groupBy("s1").count().where("count > 1"), "duplicate_row", "s1"),
        _rule(listed.where(F.size("ids") != F.size(F.array_distinct("ids"))), "duplicate_in_list", "s1"),
        _rule(one.where(F.startswith("id", F.lit(own))), "self_match", "id"),
        _rule(other.where(~fits), "bad_prefix", "id"),
        _rule(must.join(rows, "s1", "left_anti"), "missing_row", "s1"),
        _rule(rows.join(must, "s1", "left_anti"), "extra_row", "s1"),
    ]
    if known is not None:
        rules.append(_rule(other.where(fits).join(known.select("id").distinct(), "id", "left_anti"), "unknown_id", "id"))
    return _all(rules)


def matches_outside_candidates(matching: DataFrame, candidates: DataFrame) -> DataFrame:
    """A warning only: entities with matches that are not among their candidates; both (s1, id)."""
    return _rule(matching.join(candidates.select("s1", "id").distinct(), ["s1", "id"], "left_anti"), "match_outside_candidates", "s1")


def read_lines(spark, path: str) -> tuple[list[str], DataFrame]:
    """The header's problems are the caller's to check: (header as a list of one line, the other lines)."""
    df = spark.read.text(path)
    head = df.limit(1).collect()
    header = head[0].value if head else ""
    return [header], df.where(F.col("value") != header).select(F.col("value").alias("line"))
