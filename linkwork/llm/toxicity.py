"""Toxicity: nearest labelled examples by exact cosine of TF-IDF weights, raised for telling terms.

Terms are 64-bit hashes of words and of word beginnings (4, 5 and 6 bytes), A-Z
lower-cased. All terms of a bounded, stratified sample of labelled rows span the
index; the document frequency of every term is counted over all documents, and
the norm of a text takes all its terms, also those that no example has. The
commonest ``KNOWN`` frequencies are broadcast, those of other terms come by a join.
The labelled examples make a block-max inverted index: examples of like terms
stand in blocks, and for each common term and block the largest weight is kept. A
query adds these, and what its rarer terms give by their short postings, up to a
bound for each block and opens blocks in falling order of bounds until none can
hold a nearer example than the k-th found, so its k nearest are exact. Terms that tell the labels apart (in 3 examples at least) weigh more by
their chi-squared, in all texts alike; all others have their TF-IDF weight. Votes
weigh by squared cosine, with the share of each class in all labelled rows, plus
a weak prior; texts without any term get the share of label 1
among the sample's texts without any, those that share no term with an example
the share in all labelled rows.

Defined results: null, empty and wordless texts have no terms; labels that are
null are no labels; labels of an id that disagree count by their mean; without
labels all scores are 0; ties of cosine go to the earlier example; repeated rows
are scored each; documents may have other columns of any name.
"""

from __future__ import annotations

from dataclasses import dataclass, replace

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_array, crc_mod, encode, materialise, mix64, parts, prepare, segment_sums, settle, space_words, texts, word_bytes, word_hashes
from .quality import labelled

#: Labelled examples, at most (half of each label where there are enough).
MAX_TRAIN = 4000
#: Chi-squared from which a term weighs more.
TELLING = 25
#: Terms that the index keeps as blocks of numbers, at most; the others have postings.
COMMON = 2048
#: Document frequencies that are broadcast, at most.
KNOWN = 1 << 18
#: Queries that are searched together.
QUERIES = 128


def term_features(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of each word: itself and its first 4, 5 and 6 bytes, and which of these there are. One row a word."""
    raw, off = word_bytes(words)
    n = len(off) - 1
    out, there = np.zeros((n, 4), np.int64), np.zeros((n, 4), bool)
    if not n:
        return out, there
    out[:, 0], there[:, 0] = word_hashes(words).view(np.int64), True
    lens = np.diff(off)
    code = np.zeros(n, np.uint64)
    for k in range(6):
        ok = lens > k
        code[ok] = code[ok] << np.uint64(8) | raw[off[:-1][ok] + k].astype(np.uint64)
        if k >= 3:
            out[ok, k - 2] = mix64(code[ok] + (np.uint64(k) << np.uint64(56))).view(np.int64)
            there[ok, k - 2] = True
    return out, there


def bags(text: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """(document, number of the term, count), sorted, of the texts' terms; and the sorted hashes of the terms."""
    flat, offsets = space_words(text)
    codes, words = encode(flat)
    feature, there = term_features(words)
    names, at = np.unique(feature[there], return_inverse=True)
    number = np.full(feature.shape, -1, np.int64)
    number[there] = at
    # words of a document once, then their terms
    size = max(len(words), 1)
    key, n = np.unique(np.repeat(np.arange(len(offsets) - 1), np.diff(offsets)) * size + codes, return_counts=True)
    doc, term = np.repeat(key // size, 4), number[key % size].ravel()
    ok = term >= 0
    size = max(len(names), 1)
    key, at = np.unique(doc[ok] * size + term[ok], return_inverse=True)
    return key // size, key % size, np.bincount(at, np.repeat(n, 4)[ok], len(key)), names


def find(names: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where ``wanted`` are among the sorted names, and whether they are."""
    if not len(names):
        return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
    at = np.minimum(np.searchsorted(names, wanted), len(names) - 1)
    return at, names[at] == wanted


def ranges(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """The numbers start[i] to end[i] - 1, one range after the other."""
    n = end - start
    return np.arange(n.sum()) + np.repeat(start - np.cumsum(n) + n, n)


class BlockMaxIndex:
    """Unit vectors of the examples in blocks of ``size`` with the largest weight of each common term in each block.

    ``vectors`` is a matrix, or (example, term, weight) sorted by example with
    the number of terms. A common term is in a 32nd of the examples, and one of
    the ``COMMON`` most frequent; the others have postings.
    """

    def __init__(self, vectors, value: np.ndarray, weight: np.ndarray, ids: list, size: int = 32):
        if isinstance(vectors, np.ndarray):
            row, term = np.nonzero(vectors)
            vectors = row, term, vectors[row, term], vectors.shape[1]
        row, term, w, n_terms = vectors
        self.value, self.weight, self.ids, self.size = value, weight, ids, size  # label and weight of the votes
        blocks = -(-len(ids) // size)
        n = np.bincount(term, minlength=n_terms)
        common = np.argsort(-n, kind="stable")[:COMMON]
        common = common[n[common] * 32 >= max(len(ids), 1)]
        self.number = np.full(n_terms, -1, np.int32)
        self.number[common] = np.arange(len(common))
        own = self.number[term]
        self.dense = np.zeros((blocks, len(common), size), np.float32)
        at = own >= 0
        self.dense[row[at] // size, own[at], row[at] % size] = w[at]
        del own
        self.top = np.ascontiguousarray(self.dense.max(2).T)
        row, term, w = row[~at], term[~at], w[~at]
        order = np.lexsort((row, term)).astype(np.int32)
        self.row, self.w = row[order].astype(np.int32), w[order].astype(np.float32)
        self.post = np.searchsorted(term[order], np.arange(n_terms + 1))
        self.opened = 0

    def nearest(self, term: np.ndarray, w: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        """Numbers and products of the k nearest examples of one query with a product over 0."""
        return self.search([term], [w], k)[0]

    def search(self, terms: list[np.ndarray], ws: list[np.ndarray], k: int) -> list[tuple[np.ndarray, np.ndarray]]:
        """``nearest`` of several queries. Each opens its blocks in falling order of its bounds; queries that open a block at once share a matrix product."""
        blocks, size = len(self.dense), self.size
        heavy = np.zeros((len(terms), self.dense.shape[1]), np.float32)
        light = np.zeros((len(terms), blocks, size), np.float32)
        for q, (term, w) in enumerate(zip(terms, ws, strict=True)):
            number = self.number[term]
            rare = number < 0
            heavy[q, number[~rare]] = w[~rare]
            a, z = self.post[term[rare]], self.post[term[rare] + 1]
            at = ranges(a, z)
            light[q] = np.bincount(self.row[at], np.repeat(w[rare], z - a) * self.w[at], blocks * size).reshape(-1, size)
        bound = light.max(2) + heavy @ self.top
        order = np.argsort(-bound, axis=1, kind="stable")
        bound = np.take_along_axis(bound, order, 1)
        slack = np.array([1e-5 * float(w.sum()) for w in ws])
        best = np.full((len(terms), blocks * size), -1, np.float32)
        kth, i, step, open_ = np.zeros(len(terms)), 0, 2, np.arange(len(terms))
        while i < blocks and len(open_):  # more blocks at a time
            todo = (bound[open_, i : i + step] > np.maximum(kth - slack, 0)[open_, None]).nonzero()
            query, block = open_[todo[0]], order[open_[todo[0]], i + todo[1]]
            self.opened += len(query)
            by = np.argsort(block, kind="stable")
            query, block = query[by], block[by]
            cuts = np.flatnonzero(np.diff(block, prepend=-1, append=-1))
            for x, y in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                q, v = query[x:y], int(block[x])
                best[q, v * size : (v + 1) * size] = heavy[q] @ self.dense[v] + light[q, v]
            i, step = i + step, 2 * step
            if blocks * size > k:
                kth[open_] = -np.partition(-best[open_], k - 1, axis=1)[:, k - 1]
            if i < blocks:
                open_ = open_[bound[open_, i] > np.maximum(kth - slack, 0)[open_]]
        out = []
        for q, (term, w) in enumerate(zip(terms, ws, strict=True)):
            found = np.flatnonzero(best[q] > max(kth[q] - slack[q], 0))
            number = self.number[term]
            own = number >= 0
            # once more with doubles and in one order, so that equal texts and examples are equal
            s = (self.dense[found[:, None] // size, number[own], found[:, None] % size] * w[own].astype(float)).sum(1) + light[q].ravel()[found]
            top = np.lexsort((found, -s))[:k]
            top = top[s[top] > 1e-9]
            out.append((found[top], s[top]))
        return out


def term_factors(doc: np.ndarray, term: np.ndarray, y: np.ndarray, n_terms: int) -> np.ndarray:
    """What the TF-IDF weight of each term is multiplied by: chi-squared over ``TELLING``, 1 at least."""
    n = np.bincount(term, minlength=n_terms).astype(float)
    a = np.bincount(term, y[doc], minlength=n_terms)
    total, pos = len(y), y.sum()
    with np.errstate(divide="ignore", invalid="ignore"):
        chi = (a - n * pos / max(total, 1)) ** 2 * float(total) ** 3 / (n * (total - n) * pos * (total - pos))
    return np.where((n >= 3) & np.isfinite(chi), np.maximum(chi / TELLING, 1), 1.0)


def build_index(doc: np.ndarray, term: np.ndarray, w: np.ndarray, n_terms: int, y: np.ndarray, weight: np.ndarray, ids: list) -> BlockMaxIndex | None:
    """The index of the examples with terms: (example, term, weight) sorted by example and term."""
    if not len(doc):
        return None
    w = w / np.sqrt(np.bincount(doc, w * w, len(y))).astype(np.float32)[doc]
    off = np.searchsorted(doc, np.arange(len(y) + 1))
    # examples of one leading term, of those that can fill a block, stand together
    order = np.lexsort((w, doc)).astype(np.int32)
    order = order[np.bincount(term, minlength=n_terms)[term[order]] >= 32]
    lead = np.full(len(y), -1)
    lead[doc[order]] = term[order]
    del order
    rows = np.flatnonzero(np.diff(off))
    rows = rows[np.lexsort((rows, lead[rows]))]
    at = ranges(off[rows], off[rows + 1]).astype(np.int32)
    vectors = np.repeat(np.arange(len(rows), dtype=np.int32), np.diff(off)[rows]), term[at].astype(np.int32), w[at], n_terms
    del at, w, doc, term
    return BlockMaxIndex(vectors, y[rows].astype(float), weight[rows], [ids[i] for i in rows])


@dataclass
class Model:
    terms: np.ndarray  # sorted hashes of the examples' terms
    weight: np.ndarray
    index: BlockMaxIndex | None
    empty: float
    prior: float
    top: np.ndarray  # sorted hashes of the commonest terms
    top_weight: np.ndarray
    totals: DataFrame | None  # all terms' document frequencies, where ``top`` lacks some
    n_docs: int
    k: int = 15
    alpha: float = 0.05

    def vote(self, terms: list[np.ndarray], ws: list[np.ndarray]) -> list[tuple[float, float, list]]:
        """Of each query: summed votes for label 1 and of all, by squared products with the nearest examples; the first three."""
        if self.index is None:
            return [(0.0, 0.0, [])] * len(terms)
        out = []
        for i in range(0, len(terms), QUERIES):
            for number, product in self.index.search(terms[i : i + QUERIES], ws[i : i + QUERIES], self.k):
                v = product**2 * self.index.weight[number]
                out.append((float(v @ self.index.value[number]), float(v.sum()), [self.index.ids[x] for x in number[:3]]))
        return out

    def votes(self, text: pa.Array) -> list:
        """Of each text: votes for label 1 and of all, squared norm by the known terms, evidence; other terms and their squared counts' weights."""
        doc, term, n, names = bags(text)
        off = np.searchsorted(doc, np.arange(len(text) + 1))
        tf = 1 + np.log(n)
        at, ours = find(self.terms, names)
        top, known = find(self.top, names)
        known |= ours
        weight = np.zeros(len(names))
        weight[known] = self.top_weight[top[known]] if len(self.top) else 0
        weight[ours] = self.weight[at[ours]]
        square = segment_sums((tf * weight[term]) ** 2, off)
        rest = ~known[term]
        mine = np.flatnonzero(ours[term])
        own, w = at[term[mine]], (tf * weight[term])[mine].astype(np.float32)
        cut = np.searchsorted(mine, off)
        spans = list(zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True))
        first: dict[bytes, int] = {}  # texts of equal terms are searched once
        same = [first.setdefault(own[a:z].tobytes() + w[a:z].tobytes(), i) for i, (a, z) in enumerate(spans)]
        asked = [i for i in first.values() if spans[i][1] > spans[i][0]]
        got = dict(zip(asked, self.vote([own[slice(*spans[i])] for i in asked], [w[slice(*spans[i])] for i in asked]), strict=True))
        out = [got.get(i, (0.0, 0.0, [])) for i in same]
        r_off = pa.array(np.concatenate([[0], np.cumsum(rest)])[off].astype(np.int32))
        lists = [pa.ListArray.from_arrays(r_off, pa.array(x)) for x in (names[term[rest]], tf[rest] ** 2)]
        sums = [pa.array([x[i] for x in out], pa.float64()) for i in range(2)]
        return [*sums, pa.array(square), pa.array([x[2] for x in out], pa.list_(pa.string())), *lists]


def document_frequencies(key: DataFrame) -> DataFrame:
    """(h, c): in how many of the texts each term occurs; a written table."""

    def run(batches):
        for b in (x for whole in batches for x in parts(whole)):
            _, term, _, names = bags(b.column("text"))
            yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(np.bincount(term, minlength=len(names)).astype(np.int64))], ["h", "c"])

    return materialise(key.select("text").mapInArrow(run, "h long, c long").groupBy("h").agg(F.sum("c").alias("c")))


def commonest(totals: DataFrame, known: int) -> int:
    """The least frequency that at most ``known`` terms reach, by the numbers of terms of each frequency."""
    reached, least = 0, 1
    for r in totals.groupBy("c").count().orderBy(F.col("c").desc()).toLocalIterator():
        reached += r["count"]
        if reached > known:
            least = r.c + 1
            break
    return least


def fit(docs: DataFrame, labels: DataFrame, label: str = "toxic", folds: int = 5, max_train: int = MAX_TRAIN, id_col: str = "doc_id", k: int = 15, known: int = KNOWN) -> tuple[Model, DataFrame]:
    """The model and the ids and texts of all documents, which give the document frequencies."""
    spark = prepare(docs.sparkSession)

    def featurise(batches):
        for b in batches:
            doc, term, n, names = bags(as_array(b.column("text")))
            off = pa.array(np.searchsorted(doc, np.arange(b.num_rows + 1)).astype(np.int32))
            yield pa.RecordBatch.from_arrays([b.column("id").cast(pa.string()), b.column("y"), pa.ListArray.from_arrays(off, pa.array(names[term])), pa.ListArray.from_arrays(off, pa.array(n.astype(np.int32)))], ["id", "y", "term", "n"])

    got = labelled(docs, labels, label, folds, id_col, max_train, by_class=True).mapInArrow(featurise, "id string, y int, term array<long>, n array<int>").toArrow().sort_by("id")
    key = texts(docs, id_col)
    y, ids = got["y"].to_numpy().astype(np.int64), got["id"].to_pylist()
    lists, n = got["term"].combine_chunks(), got["n"].combine_chunks().flatten().to_numpy()
    doc = np.repeat(np.arange(len(y), dtype=np.int32), np.diff(lists.offsets.to_numpy()))
    terms = np.unique(lists.flatten().to_numpy())
    term = np.searchsorted(terms, lists.flatten().to_numpy()).astype(np.int32)
    tf = (1 + np.log(n)).astype(np.float32)
    del got, lists, n
    settle(spark)
    shares = {r.y: r["count"] for r in labels.where(F.col(label).isNotNull() & (crc_mod(F.col("doc_id"), folds) != 0)).groupBy(F.col(label).cast("int").alias("y")).count().collect()} if len(y) else {}
    prior = shares.get(1, 0) / max(sum(shares.values()), 1)
    weight = np.where(y == 1, prior / max(y.mean(), 1e-9), (1 - prior) / max(1 - y.mean(), 1e-9)) if len(y) else np.zeros(0)
    none = np.bincount(doc, minlength=len(y)) == 0
    empty = float((weight * y)[none].sum() / weight[none].sum()) if none.any() else prior
    if not len(terms):
        return Model(terms, np.zeros(0), None, empty, prior, terms, np.zeros(0), None, 0, k), key
    totals = document_frequencies(key)
    n_docs = docs.count()
    weigh = lambda df: np.log((1 + n_docs) / (1 + df)) + 1
    shared = spark.sparkContext.broadcast(terms)  # the terms of at most max_train texts

    def among(batches):
        for b in batches:
            yield b.filter(pa.array(find(shared.value, b.column("h").to_numpy())[1]))

    own = totals.mapInArrow(among, "h long, c long").toArrow()
    df = np.zeros(len(terms))
    df_at = np.searchsorted(terms, own["h"].to_numpy())
    df[df_at] = own["c"].to_numpy()
    del own, df_at
    settle(spark)  # what the examples' terms take in Python comes on top of the JVM
    own_weight = weigh(df) * term_factors(doc, term, y, len(terms))
    index = build_index(doc, term, tf * own_weight[term].astype(np.float32), len(terms), y, weight, ids)
    del doc, term, tf
    settle(spark)
    # the frequencies from the least one of which there are not too many
    least = commonest(totals, known)
    top = totals.where(F.col("c") >= least).toArrow().sort_by("h")
    rest = totals if least > 1 else None
    return Model(terms, own_weight, index, empty, prior, top["h"].to_numpy(), weigh(top["c"].to_numpy()), rest, n_docs, k), key


def score(docs: DataFrame, model: Model, threshold: float = 0.5, folds: int = 5, id_col: str = "doc_id") -> DataFrame:
    """Per document row: held_out, score, predicted (score >= threshold), evidence (ids of the nearest examples)."""
    kind = docs.schema["id"].dataType.simpleString()
    totals, n_docs = model.totals, model.n_docs
    shared = docs.sparkSession.sparkContext.broadcast(replace(model, totals=None))

    def run(batches):
        task, row = TaskContext.get().partitionId() << 36, 0
        for b in (x for whole in batches for x in parts(whole)):
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(task + row + np.arange(b.num_rows)), *shared.value.votes(b.column("text"))], ["id", "row", "one", "both", "square", "evidence", "h", "tf2"])
            row += b.num_rows

    out = docs.mapInArrow(run, f"id {kind}, row long, one double, both double, square double, evidence array<string>, h array<long>, tf2 array<double>")
    if totals is not None:
        # the terms outside the broadcast frequencies get theirs by a join
        out = materialise(out)
        rest = out.select("row", F.explode(F.arrays_zip("h", "tf2")).alias("x")).select("row", "x.h", "x.tf2").join(totals, "h")
        rest = rest.groupBy("row").agg(F.sum(F.col("tf2") * F.pow(F.log((1 + n_docs) / (1 + F.col("c"))) + 1, F.lit(2.0))).alias("more"))
        out = out.join(rest, "row", "left").withColumn("square", F.col("square") + F.coalesce("more", F.lit(0.0)))
    no_terms = (F.col("square") == 0) | F.lit(model.index is None)
    a = F.lit(model.alpha) * F.col("square")
    value = F.when(no_terms, F.lit(float(model.empty))).otherwise((F.col("one") + a * float(model.prior)) / (F.col("both") + a))
    out = out.select("id", value.alias("score"), "evidence")
    return out.select(F.col("id").alias(id_col), (crc_mod(F.col("id"), folds) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"), "evidence")
