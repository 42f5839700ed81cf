"""Sharding by balanced label propagation.

Documents are linked when they share a link key (for the query: equal texts).
Every document begins in the shard its hash names. In each round the links of a
cluster are counted by shard, and its documents want to be where most of its
bytes are; of those that want to move, each shard takes as many as its quota
allows, chosen by a histogram of hashes. A cluster larger than a quarter of a
shard is dealt to parts first, so that none has to be in one place. At last
documents without links, and those by which a shard is over its size, fill what
shards lack: large ones first, so that the smallest make sizes even.

Only DataFrame functions are used; sums that the driver reads are by shard (a
few numbers). Law: ``bytes``.

Defined results: a null text has size 1 and the crc32 of no bytes, and null
texts count as equal; empty tables give empty results; repeated rows are placed
each; a null id is an id like any other; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise

ROUNDS = 3
#: Buckets of hashes for running sums: the rows of the tables that are broadcast.
BUCKETS = 4096


def _bucket(n: int = BUCKETS):
    return F.pmod(F.shiftright("h", 20), F.lit(n))


def _case(values: dict[int, int | float], column, default):
    out = None
    for k, v in values.items():
        out = F.when(column == k, F.lit(v)) if out is None else out.when(column == k, F.lit(v))
    return F.lit(default) if out is None else out.otherwise(F.lit(default))


def _loads(df: DataFrame, shards: int, shard: str = "shard") -> list[int]:
    got = {r[0]: r[1] for r in df.groupBy(shard).agg(F.sum("size")).collect()}
    return [got.get(s, 0) or 0 for s in range(shards)]


def propagate(linked: DataFrame, shards: int, quota: float, rounds: int = ROUNDS) -> DataFrame:
    """Rounds of label propagation over (h, size, cluster, shard), under a quota of bytes for each shard."""
    for _ in range(rounds):
        loads = _loads(linked, shards)
        wish = linked.groupBy("cluster", "shard").agg(F.sum("size").alias("b")).groupBy("cluster").agg(F.max_by("shard", F.struct(F.col("b"), -F.col("shard"))).alias("want"))
        moves = materialise(linked.join(wish, "cluster"))
        ask = moves.where("want <> shard").groupBy("want", _bucket(256).alias("k")).agg(F.sum("size").alias("b"))
        upto = F.sum("b").over(Window.partitionBy("want").orderBy("k").rowsBetween(Window.unboundedPreceding, 0))
        room = _case({s: max(0.0, quota - x) for s, x in enumerate(loads)}, F.col("want"), 0.0)
        cuts = {r.want: r.k for r in ask.withColumn("upto", upto).where(F.col("upto") <= room).groupBy("want").agg(F.max("k").alias("k")).collect()}
        if not cuts:
            return moves.drop("want")
        goes = (F.col("want") != F.col("shard")) & (_bucket(256) <= _case(cuts, F.col("want"), -1))
        linked = moves.withColumn("shard", F.when(goes, F.col("want")).otherwise(F.col("shard"))).drop("want")
    return linked


def _line(free: DataFrame, order: list[str]) -> DataFrame:
    """Each row's middle on a line of all rows' sizes, in order of hashes: sums of buckets, then within them."""
    sums = free.groupBy(_bucket().alias("k")).agg(F.sum("size").alias("b"))
    before = sums.select("k", (F.sum("b").over(Window.orderBy("k")) - F.col("b")).alias("before"))
    own = Window.partitionBy("k").orderBy("h", *order).rowsBetween(Window.unboundedPreceding, 0)
    return free.withColumn("k", _bucket()).join(F.broadcast(before), "k").withColumn("at", F.col("before") + F.sum("size").over(own) - F.col("size") / 2).drop("k", "before")


def fill(free: DataFrame, lacks: list[float], order: list[str], mean: float) -> DataFrame:
    """A shard for each of the free rows, by what each shard lacks; classes of sizes, from the largest, each even out the one before."""
    edges = [mean / 50, mean / 500, mean / 5000]
    kind = sum(((F.col("size") <= e).cast("int") for e in edges), F.lit(0))
    free = materialise(free.withColumn("kind", kind))
    kinds = {r.kind: r.b for r in free.groupBy("kind").agg(F.sum("size").alias("b")).collect()}
    out = None
    lacks = list(lacks)
    for k in sorted(kinds):
        want = [max(0.0, x) for x in lacks]
        scale = kinds[k] / (sum(want) or 1.0)
        if not sum(want):
            want, scale = [1.0] * len(want), kinds[k] / len(want)
        shard, edge = F.lit(len(want) - 1), 0.0
        cut = []
        for s, x in enumerate(want[:-1]):
            edge += x * scale
            cut.append((s, edge))
        for s, e in reversed(cut):
            shard = F.when(F.col("at") < e, s).otherwise(shard)
        part = materialise(_line(free.where(F.col("kind") == k), order).withColumn("shard", shard.cast("int")).drop("at", "kind"))
        for s, x in enumerate(_loads(part, len(lacks))):
            lacks[s] -= x
        out = part if out is None else out.unionByName(part)
    return out


def assign(rows: DataFrame, shards: int, link: list[str], order: list[str]) -> DataFrame:
    """``rows`` with a shard. They have h (a hash), size and the columns of ``link``; ``order`` makes ties of h definite."""
    rows = materialise(rows)
    total = rows.agg(F.sum("size")).first()[0] or 0
    mean = total / shards
    groups = rows.groupBy(*link).agg(F.count("*").alias("n"), F.sum("size").alias("group_size")).where("n > 1")
    parts = F.ceil(F.col("group_size") / F.lit(max(mean / 4, 1.0)))
    both = rows.join(groups, link, "left")
    both = materialise(both.withColumn("cluster", F.when(F.col("n").isNotNull(), F.xxhash64(*link, F.pmod(F.xxhash64(F.col("h"), F.lit(1)), parts)))).withColumn("shard", F.pmod("h", F.lit(shards)).cast("int")).drop("n", "group_size"))
    linked = propagate(both.where("cluster is not null"), shards, mean)
    # by what a shard is over, its documents of least hash go with those without links
    over = {s: x - mean for s, x in enumerate(_loads(linked, shards)) if x > mean}
    if over:
        sums = linked.where(F.col("shard").isin(list(over))).groupBy("shard", _bucket(256).alias("k")).agg(F.sum("size").alias("b"))
        upto = F.sum("b").over(Window.partitionBy("shard").orderBy("k").rowsBetween(Window.unboundedPreceding, -1))
        cuts = {r.shard: r.k for r in sums.withColumn("upto", F.coalesce(upto, F.lit(0))).where(F.col("upto") < _case(over, F.col("shard"), 0.0)).groupBy("shard").agg(F.max("k").alias("k")).collect()}
        out = _bucket(256) <= _case(cuts, F.col("shard"), -1)
        evicted, linked = linked.where(out), linked.where(~out)
    free = both.where("cluster is null").drop("shard", "cluster")
    if over:
        free = free.unionByName(evicted.drop("shard", "cluster"))
    linked = linked.drop("cluster")
    lacks = [mean - x for x in _loads(linked, shards)]
    filled = fill(free, lacks, order, mean)
    return linked if filled is None else linked.unionByName(filled)


def with_slots(placed: DataFrame, order: list[str], shards: int) -> DataFrame:
    """Slots without gaps in each shard: counts of its buckets, then places in them."""
    n = max(1, 2 * BUCKETS // shards)
    counts = placed.groupBy("shard", _bucket(n).alias("k")).agg(F.count("*").alias("n"))
    before = counts.select("shard", "k", (F.sum("n").over(Window.partitionBy("shard").orderBy("k")) - F.col("n")).alias("before"))
    place = F.row_number().over(Window.partitionBy("shard", "k").orderBy("h", *order))
    return placed.withColumn("k", _bucket(n)).join(F.broadcast(before), ["shard", "k"]).withColumn("slot", F.col("before") + place - 1).drop("k", "before")


def shard(docs: DataFrame, shards: int = 16, id_col: str = "doc_id") -> DataFrame:
    """Per document row: size, text_crc32, law, shard, slot, grown_shard (null under this law)."""
    text = F.col("text").cast("string").cast("binary")
    rows = docs.select(
        F.col(id_col).alias("id"),
        (F.coalesce(F.octet_length(text), F.lit(0)) + 1).cast("long").alias("size"),
        F.crc32(F.coalesce(text, F.lit(b""))).alias("text_crc32"),
        F.xxhash64(text).alias("text_hash"),
    ).withColumn("h", F.xxhash64(F.lit(11), "id", "text_hash"))
    placed = with_slots(assign(rows, shards, ["text_hash", "text_crc32"], ["id"]), ["id"], shards)
    return placed.select(F.col("id").alias(id_col), "size", "text_crc32", F.lit("bytes").alias("law"), "shard", F.col("slot").cast("long").alias("slot"), F.lit(None).cast("int").alias("grown_shard"))
