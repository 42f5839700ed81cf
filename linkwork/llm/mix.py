"""Mixing sources to target weights by hash-threshold histograms.

A document's place is a hash of its id. Words are summed by source and hash
bucket; the bucket in which a source's budget ends is found in the running sums
and only that one is refined, by the next bits and at last by single hashes. A
document is taken when its hash is at most its source's threshold: a filter, so
nothing is sorted, thresholds of growing budgets are nested and reruns agree.
Sources with a budget over their size give every document once, and those
under the threshold once more.

Targets: sources in order of code points, null last, weigh 5, 2, 1 and so on
anew; budgets are ``rate`` times all words shared by weight; what is over
``cap`` times a source's words is shared anew among the others.

Defined results: a null text has size 0; a null source is one source; documents
of equal id (repeated rows) are taken together; a null id counts as the empty
id; without words all targets are 0; other columns are kept by ``mixed`` and not
looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, with_word_counts

WEIGHTS = (5, 2, 1)
#: Bits of the hash, and of a histogram's buckets.
HASH_BITS, BITS = 60, 12
#: Sources up to which their table is broadcast; beyond, the join shuffles.
BROADCAST_SOURCES = 50_000


def _hash(column):
    return F.conv(F.substring(F.md5(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), 1, HASH_BITS // 4), 16, 10).cast("long")


def _source_key(column):
    return F.when(column.isNull(), F.lit("n")).otherwise(F.concat(F.lit("s"), column.cast("string")))


def targets(totals: DataFrame, rate: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(key, source_size, target) of a table (key, source, source_size) of sources."""
    order = Window.orderBy(F.col("source").isNull(), F.col("source"))
    weight = F.element_at(F.array(*[F.lit(float(w)) for w in WEIGHTS]), (F.row_number().over(order) - 1) % len(WEIGHTS) + 1)
    t = totals.withColumn("w", weight).withColumn("full", cap * F.col("source_size"))
    # in the order in which sources reach their cap: what the earlier ones leave, by weight, says who is above
    by_need = Window.orderBy(F.col("full") / F.col("w"), "key")
    before = by_need.rowsBetween(Window.unboundedPreceding, -1)
    every = Window.partitionBy()
    left = rate * F.sum("source_size").over(every) - F.coalesce(F.sum("full").over(before), F.lit(0.0))
    level = left / (F.sum("w").over(every) - F.coalesce(F.sum("w").over(before), F.lit(0.0)))
    t = t.withColumn("level", level).withColumn("capped", F.col("full") <= F.col("level") * F.col("w"))
    free = F.min_by(F.when(~F.col("capped"), F.col("level")), F.when(~F.col("capped"), F.col("full") / F.col("w"))).over(every)
    return t.select("key", "source_size", F.round(F.when(F.col("capped"), F.col("full")).otherwise(F.col("w") * free), 4).alias("target"))


def plan(slim: DataFrame, rate: float = 1.5, cap: float = 2.0) -> DataFrame:
    """(key, source_size, target, copies, threshold): all documents ``copies`` times, once more up to the threshold."""
    slim = slim.withColumn("key", _source_key(F.col("source")))
    shift = HASH_BITS - BITS
    first = materialise(slim.groupBy("key", F.shiftright("h", shift).alias("bucket")).agg(F.first("source").alias("source"), F.sum("size").alias("words")))
    totals = first.groupBy("key").agg(F.first("source").alias("source"), F.sum("words").alias("source_size"))
    goal = targets(totals, rate, cap).withColumn("copies", (F.col("target") >= F.col("source_size")).cast("long"))
    goal = materialise(goal.withColumn("rest", F.col("target") - F.col("copies") * F.col("source_size")))
    small = goal.count() <= BROADCAST_SOURCES
    hint = F.broadcast if small else (lambda df: df)
    bounds, histogram = goal.withColumn("base", F.lit(0).cast("long")), first
    running = Window.partitionBy("key").orderBy("bucket").rowsBetween(Window.unboundedPreceding, 0)
    while True:
        # the bucket in which the budget ends: the first whose running sum reaches it, else the last
        sums = histogram.select("key", "bucket", "words", F.sum("words").over(running).alias("upto")).join(hint(bounds), "key")
        upto = F.col("base") + F.col("upto")
        ends = sums.groupBy("key").agg(
            F.coalesce(F.min(F.when(upto >= F.col("rest"), F.col("bucket"))), F.max("bucket")).alias("bucket"),
        )
        at = sums.join(hint(ends), ["key", "bucket"]).select("key", "source_size", "target", "copies", "rest", "bucket", (upto - F.col("words")).alias("base"), upto.alias("top"))
        if shift == 0:
            break
        bounds = materialise(at.drop("top"))
        inside = slim.join(hint(bounds.select("key", "bucket")), "key").where(F.shiftright("h", shift) == F.col("bucket"))
        shift = 0 if shift <= HASH_BITS - 3 * BITS else shift - BITS
        histogram = materialise(inside.groupBy("key", F.shiftright("h", shift).alias("bucket")).agg(F.sum("size").alias("words")))
        bounds = bounds.drop("bucket")
    # the single hash in which it ends is taken if that comes nearer
    take = F.abs(F.col("top") - F.col("rest")) < F.abs(F.col("base") - F.col("rest"))
    return at.select("key", "source_size", "target", "copies", (F.col("bucket") - F.when(take, 0).otherwise(1)).alias("threshold"))


def mix(docs: DataFrame, rate: float = 1.5, cap: float = 2.0, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """Per document row: doc_id, size, source_size, target, taken (words the mix takes, repeats counted)."""
    slim = with_word_counts(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col("text").cast("string").alias("text")))
    slim = materialise(slim.withColumn("h", _hash(F.col("id"))))
    cuts = materialise(plan(slim, rate, cap))
    if cuts.count() <= BROADCAST_SOURCES:
        cuts = F.broadcast(cuts)
    out = slim.withColumn("key", _source_key(F.col("source"))).join(cuts, "key")
    times = F.col("copies") + (F.col("h") <= F.col("threshold")).cast("long")
    return out.select(F.col("id").alias(id_col), "size", "source_size", "target", (F.col("size") * times).alias("taken"))


def mixed(docs: DataFrame, rate: float = 1.5, cap: float = 2.0, id_col: str = "doc_id", source_col: str = "source") -> DataFrame:
    """The mix itself: each document as often as it is taken, columns as they were."""
    slim = with_word_counts(docs.select(F.col(id_col).alias("id"), F.col(source_col).cast("string").alias("source"), F.col("text").cast("string").alias("text")))
    cuts = materialise(plan(materialise(slim.withColumn("h", _hash(F.col("id")))), rate, cap).select(F.col("key").alias("__key"), F.col("copies").alias("__copies"), F.col("threshold").alias("__threshold")))
    if cuts.count() <= BROADCAST_SOURCES:
        cuts = F.broadcast(cuts)
    out = docs.withColumn("__key", _source_key(F.col(source_col))).join(cuts, "__key")
    times = F.col("__copies") + (_hash(F.col(id_col)) <= F.col("__threshold")).cast("long")
    return out.withColumn("__copy", F.explode(F.sequence(F.lit(1), F.greatest(times, F.lit(1))))).where(times >= F.col("__copy")).select(*docs.columns)


ORACLE_SQL = r"""
WITH d AS (
  SELECT doc_id, source, CASE WHEN source IS NULL THEN 'n' ELSE 's' || source END AS key,
         coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
         ('0x' || substr(md5(coalesce(doc_id::VARCHAR, '')), 1, 15))::BIGINT AS h
  FROM documents),
s AS (SELECT key, source, sum(size)::BIGINT AS source_size FROM d GROUP BY ALL),
w AS (
  SELECT key, source_size, 2.0::DOUBLE * source_size AS cap,
         ([5.0, 2.0, 1.0])[((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::BIGINT]::DOUBLE AS w
  FROM s),
f AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER (ORDER BY cap / w, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / (sum(w) OVER () - coalesce(sum(w) OVER (ORDER BY cap / w, key ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) AS level
  FROM w),
t AS (
  SELECT key, source_size, round(CASE WHEN cap <= level * w THEN cap
         ELSE w * (SELECT arg_min(level, cap / w) FROM f WHERE cap > level * w) END, 4) AS target
  FROM f),
q AS (SELECT *, (target >= source_size)::BIGINT AS copies, target - (target >= source_size)::BIGINT * source_size AS rest FROM t),
g AS (SELECT key, h, sum(size) AS words FROM d GROUP BY ALL),
c AS (SELECT key, h, sum(words) OVER (PARTITION BY key ORDER BY h ROWS UNBOUNDED PRECEDING) AS top, words FROM g),
e AS (SELECT c.*, q.rest FROM c JOIN q USING (key)),
b AS (SELECT key, coalesce(min(CASE WHEN top >= rest THEN h END), max(h)) AS h FROM e GROUP BY key),
x AS (SELECT e.key, e.h - CASE WHEN abs(top - rest) < abs(top - words - rest) THEN 0 ELSE 1 END AS threshold FROM e JOIN b ON e.key = b.key AND e.h = b.h)
SELECT d.doc_id, d.size, q.source_size, q.target, (d.size * (q.copies + (d.h <= x.threshold)::BIGINT))::BIGINT AS taken
FROM d JOIN q USING (key) JOIN x USING (key)
"""
