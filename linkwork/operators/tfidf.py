"""TF-IDF cosine as relations: (group, document, gram, weight), joined on grams."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def char_wb_grams(c: Column, low: int = 3, high: int = 5) -> Column:
    """All n-grams within words padded by one space each side, repeats kept."""
    words = F.filter(F.split(F.lower(c), r"(?U)\s+"), lambda t: t != "")

    def of(word: Column) -> Column:
        w = F.concat(F.lit(" "), word, F.lit(" "))
        n = F.length(w)
        return F.flatten(F.transform(F.sequence(F.lit(low), F.least(F.lit(high), n)), lambda k: F.transform(F.sequence(F.lit(1), n - k + 1), lambda i: F.substring(w, i, k))))

    return F.flatten(F.transform(words, of))


def counts(docs: DataFrame, group: list[str], text: str) -> DataFrame:
    """(group, id, gram, tf) of documents (group, id, text)."""
    return docs.select(*group, "id", F.explode(char_wb_grams(F.coalesce(text, F.lit("")))).alias("gram")).groupBy(*group, "id", "gram").agg(F.count("*").alias("tf"))


def idf(tf: DataFrame, sizes: DataFrame, group: list[str]) -> DataFrame:
    """(group, gram, idf) with ln((1 + n) / (1 + df)) + 1; ``sizes`` has n by group."""
    df = tf.groupBy(*group, "gram").agg(F.count("*").alias("df"))
    joined = df.join(sizes, group) if group else df.crossJoin(F.broadcast(sizes))  # no group: one row
    return joined.select(*group, "gram", (F.log((1 + F.col("n")) / (1 + F.col("df"))) + 1).alias("idf"))


def weights(tf: DataFrame, weight: DataFrame, group: list[str]) -> DataFrame:
    """L2-normalised rows; grams without a weight are dropped first."""
    w = tf.join(weight, [*group, "gram"]).withColumn("w", F.col("tf") * F.col("idf"))
    norm = F.sqrt(F.sum(F.col("w") * F.col("w")).over(Window.partitionBy(*group, "id")))
    return w.select(*group, "id", "gram", (F.col("w") / norm).alias("w"))


def group_cosine(pairs: DataFrame, s1: DataFrame, s23: DataFrame, text: str) -> DataFrame:
    """(s1, rid, cosine) for pairs (s1, rid): the corpus of a query is its own pool; no shared gram gives 0.

    ``s1`` and ``s23`` have (id, text).
    """
    q = s1.select(F.col("id").alias("s1"), "id", text)
    pool = pairs.select("s1", F.col("rid").alias("id"))
    # grams are made once a record and then joined to the pools
    own = counts(s23.select("id", text).join(pool.select("id").distinct(), "id", "left_semi"), [], text)
    tf = pool.join(own, "id")
    weight = idf(tf, pool.groupBy("s1").agg(F.count("*").alias("n")), ["s1"])
    docs = weights(tf, weight, ["s1"])
    query = weights(counts(q, ["s1"], text), weight, ["s1"])
    dots = docs.select("s1", F.col("id").alias("rid"), "gram", "w").join(query.select("s1", "gram", F.col("w").alias("v")), ["s1", "gram"]).groupBy("s1", "rid").agg(F.sum(F.col("w") * F.col("v")).alias("cosine"))
    return pairs.select("s1", "rid").join(dots, ["s1", "rid"], "left").select("s1", "rid", F.coalesce("cosine", F.lit(0.0)).alias("cosine"))


def semantic(pairs: DataFrame, s1: DataFrame, s23: DataFrame, k: tuple[int, int, int] = (30, 30, 30)) -> DataFrame:
    """Cosines of name, address and both for every pair, with the flags of the best k of each; equal to nine places is a tie, by rid."""
    text = lambda d: d.select("id", F.col("normalized_name").alias("name"), F.col("normalized_address").alias("address"), F.concat_ws(" ", "normalized_name", "normalized_address").alias("combined"))
    a, b, out = text(s1), text(s23), pairs.select("s1", "rid")
    for field, top in zip(("name", "address", "combined"), k, strict=True):
        c = group_cosine(pairs, a, b, field).withColumnRenamed("cosine", f"semantic_{field}_score")
        rank = F.row_number().over(Window.partitionBy("s1").orderBy(F.desc(F.round(f"semantic_{field}_score", 9)), "rid"))
        out = out.join(c.withColumn(f"retrieved_semantic_{field}", rank <= top), ["s1", "rid"])
    return out


def reciprocal(pairs: DataFrame, s1: DataFrame, s23: DataFrame, k: int = 10, text: str = "normalized_name") -> DataFrame:
    """(s1, rid, reciprocal_rank): the rank of the query among all queries for the candidate's name, where it is in the first k.

    Worked out once for each distinct candidate name.
    """
    corpus = s1.select("id", F.col(text).alias("t"))
    tf = counts(corpus, [], "t")
    weight = idf(tf, corpus.agg(F.count("*").alias("n")), [])
    docs = weights(tf, weight, [])
    names = s23.join(pairs.select(F.col("rid").alias("id")).distinct(), "id", "left_semi").select("id", F.col(text).alias("t"))
    distinct = names.select(F.col("t").alias("id"), "t").distinct()
    query = weights(counts(distinct, [], "t"), weight, [])
    dots = query.select(F.col("id").alias("t"), "gram", "w").join(docs.select(F.col("id").alias("s1"), "gram", F.col("w").alias("v")), "gram").groupBy("t", "s1").agg(F.sum(F.col("w") * F.col("v")).alias("score"))
    rank = F.row_number().over(Window.partitionBy("t").orderBy(F.desc(F.round("score", 9)), "s1"))
    best = dots.withColumn("reciprocal_rank", rank).where(F.col("reciprocal_rank") <= k).select("t", "s1", "reciprocal_rank")
    asked = pairs.select("s1", "rid").join(names.select(F.col("id").alias("rid"), "t"), "rid")
    return asked.join(best, ["t", "s1"], "left").select("s1", "rid", "reciprocal_rank")


class TfidfBackend:
    """Weights of texts by TF-IDF; ``get_backend`` names it "tfidf"."""

    def fit(self, docs: DataFrame, text: str = "text") -> TfidfBackend:
        self.tf = counts(docs, [], text)
        self.weight = idf(self.tf, docs.agg(F.count("*").alias("n")), [])
        return self

    def embed(self, docs: DataFrame, text: str = "text") -> DataFrame:
        return weights(counts(docs, [], text), self.weight, [])


class DenseBackend:
    """Vectors that a column already has."""

    def fit(self, docs: DataFrame, text: str = "embedding") -> DenseBackend:
        return self

    def embed(self, docs: DataFrame, text: str = "embedding") -> DataFrame:
        return docs.select("id", F.col(text).alias("vector"))


class ExternalBackend(DenseBackend):
    """A place for a model outside this library."""

    def embed(self, docs: DataFrame, text: str = "text") -> DataFrame:
        raise NotImplementedError("no embedding model is given")


def get_backend(name: str):
    kinds = {"tfidf": TfidfBackend, "dense": DenseBackend, "external": ExternalBackend}
    if name not in kinds:
        raise ValueError(f"unknown backend: {name}")
    return kinds[name]()


#: Query vectors that are broadcast at once.
QUERY_BLOCK = 1 << 14
#: Queries, and rows, of one matrix of scores.
STEP = 1024


def dense_topk(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """(qid, rid, score): exact cosine of query vectors against all, in blocks of about QUERY_BLOCK queries by a hash of their id; each block's result is a table where there are several."""
    blocks = -(-queries.count() // QUERY_BLOCK)
    if blocks <= 1:
        return _block_topk(queries, index, k)
    from ..sources.tables import cut

    out = None
    for i in range(blocks):
        part = cut(_block_topk(queries.where(F.pmod(F.xxhash64("id"), F.lit(blocks)) == i), index, k))
        out = part if out is None else out.unionByName(part)
    return out


def _units(column) -> np.ndarray:
    """Rows of unit length; zeros where a vector has no length or lacks a number."""
    rows = column.to_pylist()
    d = max((len(x) for x in rows if x is not None), default=0)
    ok = [x is not None and len(x) == d and None not in x for x in rows]
    out = np.array([x if good else [0.0] * d for x, good in zip(rows, ok, strict=True)], np.float64).reshape(len(rows), d)
    size = np.sqrt((out * out).sum(1, keepdims=True))
    return np.divide(out, size, out=np.zeros_like(out), where=size > 0)


class _Best:
    """The best k of each query among the rows that ``add`` has seen: by the score to six places, then the least id."""

    def __init__(self, ids: np.ndarray, unit: np.ndarray, k: int):
        self.ids, self.unit, self.k = ids, unit, k
        self.least = np.full(len(ids), -np.inf)
        self.q, self.rid, self.score = np.zeros(0, np.int64), ids[:0], np.zeros(0)

    def add(self, rid: np.ndarray, unit: np.ndarray) -> None:
        s = self.unit @ unit.T if unit.shape[1] == self.unit.shape[1] else np.zeros((len(self.ids), len(rid)))
        least = self.least
        if len(rid) > self.k + 1 and np.isinf(least).any():  # one more, as a query may meet itself
            least = np.maximum(least, np.partition(s, len(rid) - self.k - 1, axis=1)[:, len(rid) - self.k - 1])
        q, at = np.nonzero(s >= (least - 2e-6)[:, None])
        other = rid[at] != self.ids[q]
        q, at = q[other], at[other]
        if not len(q):
            return
        exact = s[q, at]
        q, rid = np.concatenate([self.q, q]), np.concatenate([self.rid, rid[at]])
        score = np.concatenate([self.score, np.sign(exact) * np.floor(np.abs(exact) * 1e6 + 0.5) / 1e6])
        order = np.lexsort((np.unique(rid, return_inverse=True)[1], -score, q))
        q = q[order]
        place = np.arange(len(q)) - np.searchsorted(q, q)
        order, last = order[place < self.k], order[place == self.k - 1]
        self.least[q[place == self.k - 1]] = score[last]
        self.q, self.rid, self.score = q[place < self.k], rid[order], score[order]


def _block_topk(queries: DataFrame, index: DataFrame, k: int) -> DataFrame:
    """Every task keeps the best k of each query among its rows, so that only those are dealt by query."""
    asked = queries.select("id", "vector").toArrow().combine_chunks()
    kind = index.schema["id"].dataType.simpleString()
    shared = index.sparkSession.sparkContext.broadcast((asked["id"].to_numpy(), _units(asked["vector"])))  # QUERY_BLOCK rows or about

    def run(batches):
        ids, unit = shared.value
        best = [_Best(ids[i : i + STEP], unit[i : i + STEP], k) for i in range(0, len(ids), STEP)]
        for b in batches:
            rid, rows = b.column(0).to_numpy(zero_copy_only=False), _units(b.column(1))
            for i in range(0, len(rid), STEP):
                for x in best:
                    x.add(rid[i : i + STEP], rows[i : i + STEP])
        for x in best:
            yield pa.RecordBatch.from_arrays([pa.array(x.ids[x.q]), pa.array(x.rid), pa.array(x.score)], ["qid", "rid", "score"])

    scored = index.select("id", "vector").mapInArrow(run, f"qid {kind}, rid {kind}, score double")
    rank = F.row_number().over(Window.partitionBy("qid").orderBy(F.desc("score"), "rid"))
    return scored.withColumn("rank", rank).where(F.col("rank") <= k)
