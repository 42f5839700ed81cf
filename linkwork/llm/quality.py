"""Quality classifier: supervised subword embeddings.

Every word stands for hashed buckets: one of the word, and one of each 3 and 4
bytes of it (with its borders); the word pair of a word with itself has a bucket
of its own, the last. The learned vectors of all buckets of a
document are averaged and go through a softmax over two classes. Vectors and
output weights are trained together by mini-batch stochastic gradient descent
in numpy, on at most ``max_train`` labelled rows (those with the least hash of
their id, so the sample is the same in each run).

The softmax of two classes over an average is linear in the average, so for
scoring each bucket carries one number, which executors get by broadcast (a
table of fixed size), and each distinct word of a batch is looked up once.

Defined results: null, empty and wordless texts have the score of the bias
alone; labels that are null are no labels, labels of an id that disagree count
by their mean; without labels all scores are 0.5; repeated rows are scored
each; documents may have other columns of any name.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import as_array, crc_mod, encode, lean, mix64, parts, prepare, segment_sums, settle, space_words, texts, word_bytes, word_hashes

BUCKETS = 1 << 16
#: Labelled rows that the model is fitted on, at most.
MAX_TRAIN = 3000


def word_features(words: pa.Array, buckets: int = BUCKETS) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of each word, one after the other, and where each word's begin."""
    raw, off = word_bytes(words)
    n = len(off) - 1
    if not n:
        return np.zeros(0, np.int64), np.zeros(1, np.int64)
    lens = np.diff(off)
    # each word between two borders: byte values 1 to 256 with 0 as the border
    at = np.arange(len(raw)) + 2 * np.repeat(np.arange(n), lens) + 1
    padded = np.zeros(len(raw) + 2 * n, np.uint64)
    padded[at] = raw.astype(np.uint64) + 1
    start = off[:-1] + 2 * np.arange(n)
    size = lens + 2
    place = np.arange(len(padded)) - np.repeat(start, size)
    room = np.repeat(size, size) - place
    owner = np.repeat(np.arange(n), size)
    parts, owners = [(word_hashes(words) % np.uint64(buckets)).astype(np.int64)], [np.arange(n)]
    code = padded.copy()
    for k in (1, 2, 3):
        code[: len(code) - k] += padded[k:] << np.uint64(9 * k)
        if k >= 2:
            ok = room > k
            parts.append((mix64(code[ok] + np.uint64(k << 60)) % np.uint64(buckets)).astype(np.int64))
            owners.append(owner[ok])
    feature, owner = np.concatenate(parts), np.concatenate(owners)
    order = np.argsort(owner, kind="stable")
    return feature[order], np.concatenate([[0], np.cumsum(np.bincount(owner, minlength=n))])


def repeats(codes: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """In each text, the words that are the same as the one before."""
    same = np.zeros(len(codes), np.int64)
    same[1:] = codes[1:] == codes[:-1]
    same[offsets[:-1][offsets[:-1] < len(codes)]] = 0
    return segment_sums(same, offsets)


@dataclass
class Model:
    """What scoring needs: one number for each bucket, and the bias."""

    weight: np.ndarray
    bias: float
    rows: int = 0

    def score(self, text: pa.Array) -> np.ndarray:
        """Probability of label 1, in slices that bound what numpy holds at once."""
        batch = pa.RecordBatch.from_arrays([as_array(text)], ["text"])
        return np.concatenate([np.zeros(0), *(self._score(x.column(0)) for x in parts(batch, size=2 << 20))])

    def _score(self, text: pa.Array) -> np.ndarray:
        flat, offsets = space_words(text, lower=False)
        codes, words = encode(flat)
        feature, at = word_features(words, len(self.weight) - 1)
        total = segment_sums(self.weight[feature], at)[codes]
        same = repeats(codes, offsets)
        n = segment_sums(np.diff(at)[codes], offsets) + same
        logit = (segment_sums(total, offsets) + same * self.weight[-1]) / np.maximum(n, 1) + self.bias
        return 1 / (1 + np.exp(-np.clip(logit, -30, 30)))


def bag(text: pa.Array, buckets: int = BUCKETS) -> tuple[list[np.ndarray], list[np.ndarray]]:
    """Distinct buckets of each text and how often each occurs."""
    flat, offsets = space_words(text, lower=False)
    codes, words = encode(flat)
    feature, at = word_features(words, buckets)
    idx, cnt = [], []
    for a, b in zip(offsets[:-1], offsets[1:], strict=True):
        w, c = np.unique(codes[a:b], return_counts=True)
        n = np.bincount(np.concatenate([feature[at[i] : at[i + 1]] for i in w] or [np.zeros(0, np.int64)]), weights=np.repeat(c, at[w + 1] - at[w]), minlength=buckets + 1)
        n[-1] = np.count_nonzero(codes[a + 1 : b] == codes[a : b - 1]) if b > a else 0
        idx.append(np.flatnonzero(n).astype(np.int32))
        cnt.append(n[idx[-1]].astype(np.int32))
    return idx, cnt


def sgd(idx: list[np.ndarray], cnt: list[np.ndarray], y: np.ndarray, dim: int = 8, epochs: int = 6, rate: float = 2.0, batch: int = 16, seed: int = 7, buckets: int = BUCKETS) -> Model:
    """Vectors E and output weights W of softmax(W mean(E) + b), by SGD on the log loss with a falling rate."""
    if not len(y) or y.min() == y.max():
        p = np.clip(y.mean(), 0.01, 0.99) if len(y) else 0.5
        return Model(np.zeros(buckets + 1), float(np.log(p / (1 - p))), len(y))
    rng = np.random.default_rng(seed)
    vec = rng.uniform(-1, 1, (buckets + 1, dim)) / dim
    out, bias = np.zeros((2, dim)), np.log(np.clip([1 - y.mean(), y.mean()], 1e-3, 1))
    share = [c / max(c.sum(), 1) for c in cnt]
    n, step, steps = len(y), 0, epochs * -(-len(y) // batch)
    for _ in range(epochs):
        for chunk in np.array_split(rng.permutation(n), -(-n // batch)):
            lr = rate * (1 - step / steps)
            step += 1
            feats, w = np.concatenate([idx[i] for i in chunk]), np.concatenate([share[i] for i in chunk])
            row = np.repeat(np.arange(len(chunk)), [len(idx[i]) for i in chunk])
            mean = np.stack([np.bincount(row, w * vec[feats, d], len(chunk)) for d in range(dim)], 1)
            logit = mean @ out.T + bias
            p = np.exp(logit - logit.max(1, keepdims=True))
            p /= p.sum(1, keepdims=True)
            p[np.arange(len(chunk)), y[chunk]] -= 1
            back = p @ out
            out -= lr * p.T @ mean / len(chunk)
            bias -= lr * p.mean(0)
            seen, where = np.unique(feats, return_inverse=True)
            for d in range(dim):
                vec[seen, d] -= lr * np.bincount(where, w * back[row, d], len(seen))
    gap = out[1] - out[0]
    return Model(vec @ gap, float(bias[1] - bias[0]), n)


def labelled(docs: DataFrame, labels: DataFrame, label: str, folds: int = 5, id_col: str = "doc_id", limit: int = MAX_TRAIN, by_class: bool = False) -> DataFrame:
    """A bounded sample (id, text, y) of the labelled rows outside the held-out fold."""
    marks = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy(F.col("doc_id").alias("id")).agg((F.avg(label) >= 0.5).cast("int").alias("y"))
    marks = marks.where(crc_mod(F.col("id"), folds) != 0)
    if by_class:
        marks = marks.where("y = 1").orderBy(F.xxhash64("id"), "id").limit(limit // 2).unionByName(marks.where("y = 0").orderBy(F.xxhash64("id"), "id").limit(limit // 2))
    else:
        marks = marks.orderBy(F.xxhash64("id"), "id").limit(limit)
    # at most `limit` ids; a document id that repeats gives one row
    return texts(docs, id_col).join(F.broadcast(marks), "id").dropDuplicates(["id"])


def fit(docs: DataFrame, labels: DataFrame, label: str = "quality", folds: int = 5, max_train: int = MAX_TRAIN, id_col: str = "doc_id", **how) -> Model:
    """Train on a bounded sample; the texts become counts of buckets on the executors."""
    prepare(docs.sparkSession)

    def featurise(batches):
        for b in batches:
            idx, cnt = bag(as_array(b.column("text")))
            yield pa.RecordBatch.from_arrays([b.column("id").cast(pa.string()), b.column("y"), pa.array(idx, pa.list_(pa.int32())), pa.array(cnt, pa.list_(pa.int32()))], ["id", "y", "idx", "cnt"])

    got = labelled(docs, labels, label, folds, id_col, max_train).mapInArrow(lean(featurise), "id string, y int, idx array<int>, cnt array<int>").toArrow()
    got = got.sort_by("id")
    arrays = lambda c: [np.asarray(x.values) for x in got[c]]
    settle(docs.sparkSession)
    model = sgd(arrays("idx"), arrays("cnt"), got["y"].to_numpy().astype(np.int64), **how)
    del got
    settle(docs.sparkSession)
    return model


def score(docs: DataFrame, model: Model, threshold: float = 0.3, folds: int = 5, id_col: str = "doc_id") -> DataFrame:
    """Per document row: held_out, score (probability of label 1), predicted (score >= threshold)."""
    spark = prepare(docs.sparkSession)
    key = texts(docs, id_col)
    kind = key.schema["id"].dataType.simpleString()
    shared = spark.sparkContext.broadcast(model)

    def run(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(shared.value.score(b.column("text")))], ["id", "score"])

    out = key.mapInArrow(lean(run), f"id {kind}, score double")
    return out.select(F.col("id").alias(id_col), (crc_mod(F.col("id"), folds) == 0).alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))


def keep_good(docs: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """The documents with a score of at least the threshold, all columns as they were."""
    spark = prepare(docs.sparkSession)
    shared = spark.sparkContext.broadcast(model)
    at = docs.columns.index("text")

    def run(batches):
        for b in batches:
            yield b.filter(pa.array(shared.value.score(b.column(at)) >= threshold))

    return docs.mapInArrow(lean(run), docs.schema)
