"""What the corpus operators share: materialising, Arrow word splitting, shipping.

Words are split in Arrow's C++ kernels; the operators see one flat array of
words and the offset of each document in it.
"""

from __future__ import annotations

import ctypes
import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

ROOT = Path(__file__).resolve().parents[2]
_WORD_TABLE = np.arange(256, dtype=np.uint8)
_WORD_TABLE[0x41:0x5B] += 0x20
for _lo, _hi in ((0x00, 0x2F), (0x3A, 0x40), (0x5B, 0x60), (0x7B, 0x7F)):
    _WORD_TABLE[_lo : _hi + 1] = 0x20

#: A batch that goes to Python: rows and bytes at most (one longer text still goes whole).
BATCH_ROWS, BATCH_BYTES = 10_000, 16 << 20


def prepare(spark: SparkSession) -> SparkSession:
    """Session settings of the operators, and this package on the executors' path."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    sc = spark.sparkContext
    if str(ROOT) not in os.environ.get("PYTHONPATH", "").split(":") and not getattr(sc, "_linkwork_shipped", False):
        path = Path(tempfile.mkdtemp()) / "linkwork_src.zip"
        with zipfile.ZipFile(path, "w") as z:
            for p in (ROOT / "linkwork").rglob("*.py"):
                z.write(p, p.relative_to(ROOT))
        sc.addPyFile(str(path))  # the driver serves it to the executors
        sc._linkwork_shipped = True
    return spark


def release() -> None:
    """Gives what a task's worker has freed back to the system: idle workers keep no more than their broadcasts."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim is not None:
        trim(0)


def settle(spark: SparkSession) -> None:
    """The driver gives back what its Python and its JVM have freed, so that one does not hold what the other needs."""
    release()
    spark.sparkContext._jvm.System.gc()


def lean(run):
    """``run`` for ``mapInArrow``, at the end of which the worker, which waits for other tasks, gives back what it has freed."""

    def held(batches):
        try:
            yield from run(batches)
        finally:
            release()

    return held


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir; a temporary one only where that is unset."""
    path = spark.conf.get("spark.checkpoint.dir", None)
    if not path:
        path = getattr(spark.sparkContext, "_linkwork_dir", None) or tempfile.mkdtemp(prefix="linkwork-")
        spark.sparkContext._linkwork_dir = path
    return path.rstrip("/")


def materialise(df: DataFrame, *partition_by: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it: cuts the lineage and survives lost executors."""
    spark = df.sparkSession
    path = f"{shared_dir(spark)}/linkwork-{uuid.uuid4().hex}"
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    settle(spark)
    return spark.read.schema(df.schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text, so that other columns and their names never matter."""
    return df.select(F.col(id_col).alias("id"), F.col(text_col).cast("string").alias("text"))


def crc_mod(column, n: int):
    """crc32 of the id as text, modulo n; a null id counts as the empty text."""
    return F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")) % n


def as_array(x) -> pa.Array:
    x = x.combine_chunks() if isinstance(x, pa.ChunkedArray) else x
    x = x.cast(pa.string()) if x.type != pa.string() else x
    return pc.fill_null(x, "")


def _flat(lists: pa.ListArray) -> tuple[pa.Array, np.ndarray]:
    flat = lists.flatten()
    offsets = lists.offsets.to_numpy().astype(np.int64)
    offsets = offsets - offsets[0]
    full = pc.not_equal(pc.binary_length(flat), 0).to_numpy(zero_copy_only=False)
    if not full.all():
        offsets = np.concatenate([[0], np.cumsum(full)])[offsets]
        flat = flat.filter(pa.array(full))
    return flat, offsets


def parts(batch: pa.RecordBatch, column: str = "text", size: int = 4 << 20):
    """The batch in slices of about ``size`` bytes of a text column: bounds what numpy holds at once."""
    if batch.num_rows:
        lens = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        cuts = np.flatnonzero(np.diff(np.cumsum(lens) // size)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), batch.num_rows], strict=True):
            yield batch.slice(a, b - a)


def space_words(text: pa.Array, lower: bool = True) -> tuple[pa.Array, np.ndarray]:
    """Maximal runs of anything but x20 and x09-x0D; A-Z lower-cased if asked."""
    text = as_array(text)
    return _flat(pc.ascii_split_whitespace(pc.ascii_lower(text) if lower else text))


def alnum_words(text: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """Maximal runs of ASCII letters and digits and of non-ASCII characters, A-Z lower-cased."""
    text = as_array(text)
    _, off, data = text.buffers()
    if data is None or not data.size:
        return pa.array([], pa.string()), np.zeros(len(text) + 1, np.int64)
    mapped = _WORD_TABLE[np.frombuffer(data, np.uint8)]
    out = pa.Array.from_buffers(pa.string(), len(text), [None, off, pa.py_buffer(mapped)], 0, text.offset)
    return _flat(pc.ascii_split_whitespace(out))


def segment_sums(values: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Sum of each segment values[offsets[i]:offsets[i+1]]; empty ones are 0."""
    total = np.concatenate([np.zeros(1, values.dtype if values.dtype.kind == "f" else np.int64), np.cumsum(values)])
    return total[offsets[1:]] - total[offsets[:-1]]


def encode(flat: pa.Array) -> tuple[np.ndarray, pa.Array]:
    """Codes and distinct values of a flat string array."""
    d = flat.dictionary_encode()
    return d.indices.to_numpy(), d.dictionary


def word_bytes(words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of the words one after the other, and the start of each."""
    if not len(words):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    off = np.frombuffer(words.buffers()[1], np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64)
    data = words.buffers()[2]
    raw = np.frombuffer(data, np.uint8)[off[0] : off[-1]] if data is not None else np.zeros(0, np.uint8)
    return raw, off - off[0]


def mix64(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser (multiply and xor-shift), elementwise."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xFF51AFD7ED558CCD)
    x ^= x >> np.uint64(33)
    x *= np.uint64(0xC4CEB9FE1A85EC53)
    x ^= x >> np.uint64(33)
    return x


_POWERS: dict[int, np.ndarray] = {}


def _powers(n: int) -> np.ndarray:
    """Odd multipliers' powers, modulo 2**64."""
    if n not in _POWERS:
        factors = np.full(n + 1, 0x9E3779B97F4A7C15, np.uint64)
        factors[0] = 1
        _POWERS[n] = np.cumprod(factors, dtype=np.uint64)
    return _POWERS[n]


def word_hashes(words: pa.Array) -> np.ndarray:
    """A 64-bit hash of each word, by polynomial over its bytes; the same everywhere."""
    raw, off = word_bytes(words)
    n = len(off) - 1
    if not n:
        return np.zeros(0, np.uint64)
    lens = np.diff(off)
    top = 1 << int(max(lens.max(), 1)).bit_length()
    place = np.arange(len(raw)) - np.repeat(off[:-1], lens)
    value = mix64(raw.astype(np.uint64) + np.uint64(1)) * _powers(top)[place]
    total = np.concatenate([np.zeros(1, np.uint64), np.cumsum(value, dtype=np.uint64)])
    return mix64(total[off[1:]] - total[off[:-1]] + lens.astype(np.uint64) * np.uint64(0x2545F4914F6CDD1D))


def sized(name: str, n: int, bound: int) -> None:
    """Guard of what is broadcast."""
    if n > bound:
        raise ValueError(f"{name}: {n} is beyond its bound {bound}")


SPACE_WORD = r"[^\x20\x09-\x0D]+"
SPACE_RE = re.compile(SPACE_WORD)
ALNUM_RE = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_LOWER = {c: c + 32 for c in range(65, 91)}


def ascii_lower(s: str) -> str:
    return s.translate(_LOWER)


_IS_SPACE = np.zeros(256, bool)
_IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True


def word_counts(text: pa.Array) -> np.ndarray:
    """Number of ``SPACE_WORD`` in each text: places where a word begins."""
    text = as_array(text)
    raw, off = word_bytes(text)
    if not len(raw):
        return np.zeros(len(text), np.int64)
    space = _IS_SPACE[raw]
    begin = ~space
    begin[1:] &= space[:-1]
    first = off[:-1][off[:-1] < off[1:]]
    begin[first] = ~space[first]
    return np.diff(np.searchsorted(np.flatnonzero(begin), off))


def with_word_counts(df: DataFrame, name: str = "size") -> DataFrame:
    """``df``, with its column ``text`` replaced by the number of its words."""
    prepare(df.sparkSession)
    at = df.columns.index("text")
    keep = [c for c in df.columns if c != "text"]
    schema = df.drop("text").schema.add(name, "long")

    def run(batches):
        for b in batches:
            n = word_counts(b.column(at))
            yield pa.RecordBatch.from_arrays([c for i, c in enumerate(b.columns) if i != at] + [pa.array(n)], names=keep + [name])

    return df.mapInArrow(lean(run), schema)
