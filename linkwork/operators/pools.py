"""Cheap features of all pairs of the geographic pools, without a row of a pair ever being shuffled.

The records of a key come sorted to one task, queries first; candidates follow
in chunks and meet all queries of the key in matrices: shared items by inverted
lists, Jaro-Winkler on 64-bit vectors of letters (Python strings where a text is
longer).
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from decimal import ROUND_HALF_UP, Decimal

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.similarity import jaro_winkler_of, levenshtein_of

#: Candidates of a chunk, and queries that meet it at once.
CHUNK, BLOCK = 1024, 32
#: Distinct texts that meet a chunk at once.
FEW = 8
#: Pairs of some queries with all candidates of a key that are held at once (one query's always are).
ROOM = 1 << 18
#: Letters of a bit vector.
BITS = 64

SETS = {"token_overlap": "name_tokens", "char_ngram_overlap": "char_4grams", "address_token_overlap": "address_tokens"}
EQUAL = {"postal_exact": "postal_code", "city_exact": "city"}


def _codes(texts: list[str], fill: int) -> np.ndarray:
    """Code points of the first BITS letters, ``fill`` behind the end."""
    flat = np.frombuffer("".join(t[:BITS].ljust(BITS, "\0") for t in texts).encode("utf-32-le"), np.uint32).reshape(len(texts), BITS).astype(np.int64)
    flat[np.arange(BITS) >= np.array([len(t) for t in texts])[:, None]] = fill
    return flat


def _sum(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The rounded sum and what rounding took from it."""
    s = x + y
    z = s - x
    return s, (x - (s - z)) + (y - z)


def fused(x: np.ndarray, y: np.ndarray, z: np.ndarray) -> np.ndarray:
    """``math.fma`` of arrays: x * y + z in one rounding, of numbers far from the ends of the range."""
    halves = lambda v: (h := v * 134217729.0 - (v * 134217729.0 - v), v - h)
    (x1, x0), (y1, y0) = halves(x), halves(y)
    high = x * y
    low = ((x1 * y1 - high) + x1 * y0 + x0 * y1) + x0 * y0
    t, lower = _sum(z, low)
    v, rest = _sum(high, t)
    # what is left is rounded to odd, so that the last rounding is not a second one
    odd, error = _sum(lower, rest)
    bits = odd.view(np.int64).copy()
    bits += np.where((error != 0) & (bits & 1 == 0), np.where((error > 0) == (odd > 0), 1, -1), 0)
    return v + bits.view(np.float64)


def _distinct(texts: list[str]) -> tuple[list[str], np.ndarray]:
    """Distinct texts, the shortest first, and the place of each text among them."""
    own = sorted(set(texts), key=len)
    number = {t: i for i, t in enumerate(own)}
    return own, np.array([number[t] for t in texts], np.int64)


class Texts:
    """Distinct candidate texts as bit vectors: one row a letter, one column a text."""

    def __init__(self, texts: list[str]):
        self.texts, self.place = _distinct(texts)
        self.n = len(self.texts)
        texts = self.texts
        self.length = np.array([len(t) for t in texts], np.int64)
        self.codes = _codes(texts, -1)
        self.letters, row = np.unique(self.codes, return_inverse=True)
        row = row.reshape(self.codes.shape)
        self.bits = np.zeros((len(self.letters) + 1, self.n), np.uint64)  # the last: a letter that none has
        every = np.arange(self.n)
        for j in range(BITS):
            self.bits[row[:, j], every] |= np.uint64(1 << j)
        if self.letters[0] == -1:
            self.bits[0] = 0
        self.long = np.flatnonzero(self.length > BITS)

    def jaro_winkler(self, texts: list[str]) -> np.ndarray:
        """(texts, candidates); equal to ``jaro_winkler_of`` of each pair, bit by bit."""
        return self._all(texts, self._jaro_winkler)

    def _all(self, texts: list[str], of: Callable) -> np.ndarray:
        """``of`` some distinct texts of about one length at a time, for all texts and candidates."""
        own, place = _distinct(texts)
        out = np.concatenate([of(own[i : i + FEW]) for i in range(0, len(own), FEW)]) if own else np.zeros((0, self.n))
        return out[place[:, None], self.place]

    def _jaro_winkler(self, texts: list[str]) -> np.ndarray:
        codes = _codes(texts, -2)
        size = np.array([len(t) for t in texts], np.int64)
        at = np.searchsorted(self.letters, codes).clip(max=len(self.letters) - 1)
        at = np.where(self.letters[at] == codes, at, len(self.letters))
        shape = (len(texts), self.n)
        steps = min(int(size.max(initial=0)), BITS)
        reach = np.maximum(np.maximum(size[:, None], self.length) // 2 - 1, 0).clip(max=BITS - 1).astype(np.uint64)
        window = np.left_shift(np.uint64(2), reach) - np.uint64(1)  # a shift of 64 gives 0, and so all bits
        used, x, low = (np.zeros(shape, np.uint64) for _ in range(3))
        hits = np.zeros((steps, *shape), np.uint64)
        one = np.uint64(1)
        for i in range(steps):
            if i:
                np.left_shift(window, one, out=window)
                np.bitwise_or(window, reach >= i, out=window)
            np.take(self.bits, at[:, i], axis=0, out=x)
            np.bitwise_and(x, window, out=x)
            np.bitwise_and(x, ~used, out=x)
            np.negative(x, out=low)
            np.bitwise_and(x, low, out=low)
            np.bitwise_or(used, low, out=used)
            np.minimum(low, one, out=hits[i])
        m = hits.sum(axis=0).astype(np.int64)
        odd = np.zeros(shape, np.int64)
        for i in range(steps):
            np.negative(used, out=low)
            np.bitwise_and(used, low, out=low)
            np.multiply(low, hits[i], out=low)
            np.bitwise_xor(used, low, out=used)
            np.take(self.bits, at[:, i], axis=0, out=x)
            np.bitwise_and(x, low, out=x)
            odd += x != low
        with np.errstate(divide="ignore", invalid="ignore"):
            j = (m / size[:, None] + m / self.length + (m - odd // 2) / m) / 3
        out = np.where(m > 0, j, 0.0)
        a, b = np.nonzero(out > 0.7)
        same = np.cumprod(codes[a, :4] == self.codes[b, :4], axis=1).sum(axis=1)
        out[a, b] = fused(0.1 * same, 1 - out[a, b], out[a, b])
        for a in np.flatnonzero(size > BITS):
            out[a] = [jaro_winkler_of(texts[a], t) for t in self.texts]
        for a in np.flatnonzero(size <= BITS) if len(self.long) else ():
            out[a, self.long] = [jaro_winkler_of(texts[a], self.texts[b]) for b in self.long]
        return out


    def levenshtein(self, texts: list[str], both_empty: float = 0.0) -> np.ndarray:
        """(texts, candidates): 1 - distance / longer length, 0 where one is empty."""
        out = self._all(texts, self._levenshtein)
        if both_empty:
            out[np.ix_([not t for t in texts], self.length[self.place] == 0)] = both_empty
        return out

    def _levenshtein(self, texts: list[str]) -> np.ndarray:
        """Myers' columns of differences, a bit a letter of the candidate, for texts of rising length."""
        size = np.array([len(t) for t in texts], np.int64)
        steps = int(size.max(initial=0))
        codes = np.frombuffer("".join(t.ljust(steps, "\0") for t in texts).encode("utf-32-le"), np.uint32).reshape(len(texts), steps).astype(np.int64)
        at = np.searchsorted(self.letters, codes).clip(max=len(self.letters) - 1)
        at = np.where(self.letters[at] == codes, at, len(self.letters))
        one = np.uint64(1)
        last = (np.clip(self.length, 1, BITS) - 1).astype(np.uint64)
        up, down = np.full((len(texts), self.n), ~np.uint64(0)), np.zeros((len(texts), self.n), np.uint64)
        distance = np.broadcast_to(self.length, up.shape).copy()
        for i in range(steps):
            k = int(np.searchsorted(size, i, "right"))  # shorter texts are done
            u, d = up[k:], down[k:]
            x = np.take(self.bits, at[k:, i], axis=0)
            same = (((x & u) + u) ^ u) | x | d
            plus, minus = d | ~(same | u), same & u
            distance[k:] += ((plus >> last) & one).view(np.int64) - ((minus >> last) & one).view(np.int64)
            plus = (plus << one) | one
            up[k:] = (minus << one) | ~(same | plus)
            down[k:] = plus & same
        for b in self.long:
            distance[:, b] = [levenshtein_of(t, self.texts[b]) for t in texts]
        longer = np.maximum(size[:, None], self.length)
        return np.where((size[:, None] > 0) & (self.length > 0), 1 - distance / np.maximum(longer, 1), 0.0)


class Sets:
    """Inverted lists of the candidates' distinct items."""

    def __init__(self, items: list[list]):
        own = [set(x or ()) for x in items]
        self.n = np.array([len(x) for x in own], np.int64)
        where: dict = {}
        for i, x in enumerate(own):
            for t in x:
                where.setdefault(t, []).append(i)
        self.where = {t: np.array(v) for t, v in where.items()}

    def jaccard(self, items: list[list]) -> np.ndarray:
        shared = np.zeros((len(items), len(self.n)), np.int64)
        size = np.zeros((len(items), 1), np.int64)
        for i, x in enumerate(items):
            own, row = set(x or ()), shared[i]
            size[i] = len(own)
            for t in own:
                at = self.where.get(t)
                if at is not None:
                    row[at] += 1
        return shared / np.maximum(size + self.n - shared, 1)


def _equal(mine: list, theirs: list) -> np.ndarray:
    """Where both are given and equal."""
    number = {v: i for i, v in enumerate(dict.fromkeys(v for v in theirs if v is not None))}
    a, b = (np.array([number.get(v, none) if v is not None else none for v in s], np.int64) for s, none in ((mine, -1), (theirs, -2)))
    return a[:, None] == b


def _runs(batches) -> Iterator[tuple[str, int, pa.RecordBatch]]:
    """(key, side, rows) of stretches of one key and side."""
    for batch in batches:
        if not batch.num_rows:
            continue
        key, side = batch.column("geo_key").dictionary_encode(), batch.column("side").to_numpy()
        code = key.indices.to_numpy()
        cuts = [0, *(np.flatnonzero((np.diff(code) != 0) | (np.diff(side) != 0)) + 1), batch.num_rows]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            yield key.dictionary[int(code[lo])].as_py(), int(side[lo]), batch.slice(lo, hi - lo)


class Chunk:
    """Candidates of one key, made ready to meet queries."""

    def __init__(self, part: dict, sets: list[str], equal: list[str], names: bool, edits: tuple[str, ...] = ()):
        self.ids = pa.array(part["id"], pa.string())
        self.sets = {c: Sets(part[f"s_{c}"]) for c in sets}
        self.texts = Texts(part["name"]) if names else None
        self.equal = {c: part[f"e_{c}"] for c in equal}
        self.edits = {c: Texts(part[f"t_{c}"]) for c in edits}

    def columns(self, q: dict) -> dict[str, np.ndarray]:
        """Of some queries: each feature, a row a query and a column a candidate."""
        cols = {c: x.jaccard(q[f"s_{c}"]) for c, x in self.sets.items()}
        if self.texts is not None:
            cols["name_jaro_winkler"] = self.texts.jaro_winkler(q["name"])
        cols |= {c: x.levenshtein(q[f"t_{c}"]) for c, x in self.edits.items()}
        return cols | {c: _equal(q[f"e_{c}"], x).astype(np.float64) for c, x in self.equal.items()}


def rounded(x: np.ndarray, places: int) -> np.ndarray:
    """Values from 0 as Spark's ``round`` gives them: halves, which the shortest decimal form tells, go up."""
    scaled = x * 10.0**places
    out = np.rint(scaled) / 10.0**places
    unit = Decimal(1).scaleb(-places)
    for at in zip(*np.nonzero(np.abs(scaled - np.floor(scaled) - 0.5) < 1e-5), strict=True):
        out[at] = float(Decimal(repr(float(x[at]))).quantize(unit, ROUND_HALF_UP))
    return out


def rounded_sql(x: np.ndarray, places: int = 6) -> np.ndarray:
    """Values from 0 as DuckDB's ``round`` gives them: of the binary product with the power of ten, halves go up."""
    scaled = x * 10.0**places
    out = np.floor(scaled)
    out += scaled - out >= 0.5
    return out / 10.0**places


def _meet(queries: list[dict], part: dict, sets: list[str], equal: list[str], names: bool, weights: dict | None, least: float | None, best: int | None, finish: Callable | None = None, edits: tuple[str, ...] = ()):
    """Batches of the pairs of some queries with one chunk of candidates; ``finish`` gives of the features the columns."""
    n = len(part["id"])
    chunk = Chunk(part, sets, equal, names, edits)
    ids = chunk.ids
    for q in queries:
        cols = chunk.columns(q)
        k = len(q["id"])
        keep = None
        if weights:
            score = sum((cols[c] * w for c, w in weights.items()), np.zeros((k, n)))
            # rounding to nine places is left to Spark: what may tie stays
            if least is not None:
                keep = score >= least - 1e-8
            if best is not None and n > best:
                floor = np.partition(score, n - best, axis=1)[:, n - best]
                keep = score >= floor[:, None] - 1e-8
        a, b = np.divmod(np.arange(k * n) if keep is None else np.flatnonzero(keep.ravel()), n)
        if len(a):
            cols = finish(cols) if finish else cols
            yield pa.RecordBatch.from_arrays([pa.array(q["id"], pa.string()).take(pa.array(a)), ids.take(pa.array(b)), *[pa.array(v.ravel() if keep is None else v[a, b]) for v in cols.values()]], ["s1", "rid", *cols])


def _dealt(queries: DataFrame, places: DataFrame, s1: DataFrame, s23: DataFrame, sets: dict, equal: dict, names: bool, after: bool = False, given: tuple[str, ...] = (), edits: dict | None = None) -> tuple[DataFrame, list[str]]:
    """The records of both sides with what is compared and the columns ``given`` of the queries, a key in one task, queries before the candidates or after; and the names of these columns."""
    sets_of = [F.col(c).alias(f"s_{k}") for k, c in sets.items()]
    equal_of = [(F.trim(c) if isinstance(c, str) else c).alias(f"e_{k}") for k, c in equal.items()]
    edits_of = [F.coalesce(c, F.lit("")).alias(f"t_{k}") for k, c in (edits or {}).items()]
    own = lambda d, geo, side: geo.join(d.select("id", *([F.coalesce("normalized_name", F.lit("")).alias("name")] if names else []), *sets_of, *equal_of, *edits_of), "id").select("geo_key", F.lit(side).alias("side"), "*")
    fields = ["id", *(["name"] if names else []), *[f"s_{k}" for k in sets], *[f"e_{k}" for k in equal], *[f"t_{k}" for k in edits or {}], *given]
    order = ["geo_key", "side", *fields]
    both = own(s1, queries, int(after)).select(*order).unionByName(own(s23, places.withColumns({c: F.lit(None).cast(queries.schema[c].dataType) for c in given}) if given else places, int(not after)).select(*order))
    spark = s1.sparkSession
    n = max(int(spark.conf.get("spark.sql.shuffle.partitions")), 4 * spark.sparkContext.defaultParallelism)
    return both.repartition(n, "geo_key").sortWithinPartitions("geo_key", "side", "id"), fields


def pool_features(queries: DataFrame, places: DataFrame, s1: DataFrame, s23: DataFrame, sets: dict[str, str] = SETS, equal: dict[str, str | Column] = EQUAL, names: bool = True, weights: dict[str, float] | None = None, least: float | None = None, best: int | None = None, finish: Callable | None = None, columns: list[str] | None = None, edits: dict[str, str] | None = None) -> DataFrame:
    """(s1, rid, a column for each of ``sets``, ``name_jaro_winkler``, ``equal``) of every pair of the pools, or ``columns`` that ``finish`` gives of them.

    ``sets``: Jaccard of a list column; ``equal``: 1.0 where both are given and
    equal; ``edits``, for ``finish`` only: Levenshtein's likeness of a text column. With ``weights`` of columns, pairs whose weighted sum is under
    ``least``, or that some ``best`` candidates of the chunk surpass, are left
    out; those within 1e-8 of the bound stay, so it is for the caller to cut.
    """
    both, fields = _dealt(queries, places, s1, s23, sets, equal, names, edits=edits)
    set_names, equal_names, edit_names = list(sets), list(equal), tuple(edits or ())

    def run(batches):
        key, asked = None, []
        for k, side, rows in _runs(batches):
            if k != key:
                key, asked = k, []
            step = CHUNK if side else BLOCK
            for lo in range(0, rows.num_rows, step):
                part = {f: rows.column(f).slice(lo, step).to_pylist() for f in fields}
                if side:
                    yield from _meet(asked, part, set_names, equal_names, names, weights, least, best, finish, edit_names)
                else:
                    asked.append(part)

    out = ["s1 string", "rid string", *[f"{c} double" for c in columns or [*set_names, *(["name_jaro_winkler"] if names else []), *equal_names]]]
    return both.mapInArrow(run, ", ".join(out))


def pool_weighted(queries: DataFrame, places: DataFrame, s1: DataFrame, s23: DataFrame, items: str, best: int) -> DataFrame:
    """(s1, rid, score): the summed ``weights`` of the ``items`` that a query, which has both as lists, shares with a candidate's list ``items``.

    Pairs that share none, or that ``best`` candidates of the chunk surpass by more than rounding to nine places may tie, are left out.
    """
    both, fields = _dealt(queries, places, s1, s23, {"own": items}, {}, False, given=("items", "weights"))

    def run(batches):
        key, asked = None, []
        for k, side, rows in _runs(batches):
            if k != key:
                key, asked = k, []
            for lo in range(0, rows.num_rows, CHUNK):
                part = {f: rows.column(f).slice(lo, CHUNK).to_pylist() for f in fields}
                if not side:
                    asked += zip(part["id"], part["items"], part["weights"], strict=True)
                    continue
                where, ids, n = Sets(part["s_own"]).where, pa.array(part["id"], pa.string()), len(part["id"])
                who, at, scores = [], [], []
                for name, words, weights in asked:
                    score = np.zeros(n)
                    for t, w in zip(words or (), weights or (), strict=True):
                        if t in where:
                            score[where[t]] += w
                    keep = score > 0
                    if n > best:
                        keep &= score >= np.partition(score, n - best)[n - best] - 1e-8
                    found = np.flatnonzero(keep)
                    who += [name] * len(found)
                    at.append(found)
                    scores.append(score[found])
                if who:
                    yield pa.RecordBatch.from_arrays([pa.array(who, pa.string()), ids.take(pa.array(np.concatenate(at))), pa.array(np.concatenate(scores))], ["s1", "rid", "score"])

    return both.mapInArrow(run, "s1 string, rid string, score double")


class Pairs:
    """All pairs of the pools, for what takes all candidates of a query at once; the records are dealt once, however often the pairs are gone through.

    Features come as ``pool_features`` names them, a row a query and a column a
    candidate, in the order of their ids; columns ``given`` of the queries come
    beside them, a row a query. A task holds the candidates of one key, some 5 KB
    each. Ids are unique.
    """

    def __init__(self, queries: DataFrame, places: DataFrame, s1: DataFrame, s23: DataFrame, sets: dict[str, str] = SETS, equal: dict[str, str | Column] = EQUAL, names: bool = True, given: tuple[str, ...] = ()):
        self.both, self.fields = _dealt(queries, places, s1, s23, sets, equal, names, True, given)
        self.sets, self.equal, self.names, self.given = list(sets), list(equal), names, given

    def persist(self) -> Pairs:
        self.both = self.both.persist()
        return self

    def _blocks(self) -> Callable:
        """Of the batches of a task: (queries, ids of the candidates, features), some queries of a key at a time."""
        fields, sets, equal, names, given = self.fields, self.sets, self.equal, self.names, self.given

        def blocks(batches):
            key, chunks = None, []
            for k, side, rows in _runs(batches):
                if k != key:
                    key, chunks = k, []
                ids = pa.concat_arrays([c.ids for c in chunks]) if side and chunks else None
                step = min(max(ROOM // max(len(ids), 1), 1), BLOCK) if ids is not None else CHUNK
                for lo in range(0, rows.num_rows, step) if ids is not None or not side else ():
                    part = {f: rows.column(f).slice(lo, step).to_pylist() for f in fields}
                    if not side:
                        chunks.append(Chunk(part, sets, equal, names))
                        continue
                    met = [c.columns(part) for c in chunks]
                    yield part, ids, {c: np.concatenate([x[c] for x in met], axis=1) for c in met[0]} | {c: np.array(part[c])[:, None] for c in given}

        return blocks

    def of_queries(self, finish: Callable, schema: str) -> DataFrame:
        """(s1, ``schema``): ``finish`` gives of the features the columns of ``schema``, a row or list for each query."""
        blocks = self._blocks()

        def run(batches):
            for part, _, cols in blocks(batches):
                values = finish(cols)
                yield pa.RecordBatch.from_arrays([pa.array(part["id"], pa.string()), *[pa.array(list(v)) for v in values.values()]], ["s1", *values])

        return self.both.mapInArrow(run, f"s1 string, {schema}")

    def rows(self, finish: Callable, schema: str) -> DataFrame:
        """(s1, rid, ``schema``): ``finish`` gives of the features the columns of ``schema`` and which pairs stay (None: all)."""
        blocks = self._blocks()

        def run(batches):
            for part, ids, cols in blocks(batches):
                values, keep = finish(cols)
                shape = (len(part["id"]), len(ids))
                a, b = np.divmod(np.arange(shape[0] * shape[1]) if keep is None else np.flatnonzero(keep.ravel()), shape[1])
                if len(a):
                    out = [pa.array(np.broadcast_to(v, shape)[a, b]) for v in values.values()]
                    yield pa.RecordBatch.from_arrays([pa.array(part["id"], pa.string()).take(pa.array(a)), ids.take(pa.array(b)), *out], ["s1", "rid", *values])

        return self.both.mapInArrow(run, f"s1 string, rid string, {schema}")

    def counts(self, codes: Callable) -> DataFrame:
        """(code, n): how many pairs have each of the numbers that ``codes`` gives of the features, an array or more for all pairs of a block; no pair is a row."""
        blocks = self._blocks()

        def merged(held):
            code, at = np.unique(np.concatenate([c for c, _ in held]), return_inverse=True)
            return code, np.bincount(at, np.concatenate([n for _, n in held])).astype(np.int64)

        def run(batches):
            held, size = [], 0
            for part, ids, cols in blocks(batches):
                for code in codes(cols):
                    held.append(np.unique(np.broadcast_to(code, (len(part["id"]), len(ids))), return_counts=True))
                    size += len(held[-1][0])
                if size > 4 * ROOM:
                    held = [merged(held)]
                    size = len(held[0][0])
                    if size > 2 * ROOM:
                        yield pa.RecordBatch.from_arrays([pa.array(x) for x in held[0]], ["code", "n"])
                        held, size = [], 0
            if held:
                yield pa.RecordBatch.from_arrays([pa.array(x) for x in merged(held)], ["code", "n"])

        return self.both.mapInArrow(run, "code long, n long").groupBy("code").agg(F.sum("n").alias("n"))


def pool_rows(queries: DataFrame, places: DataFrame, s1: DataFrame, s23: DataFrame, finish: Callable, schema: str, sets: dict[str, str] = SETS, equal: dict[str, str | Column] = EQUAL, names: bool = True) -> DataFrame:
    """(s1, rid, ``schema``) of pairs of the pools, see ``Pairs``."""
    return Pairs(queries, places, s1, s23, sets, equal, names).rows(finish, schema)


def ranks(score: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Columns by falling score in each row, ties by column; and the place of each column, from 1."""
    order = np.argsort(-score, axis=1, kind="stable")
    place = np.empty(score.shape, np.int32)
    np.put_along_axis(place, order, np.broadcast_to(np.arange(1, score.shape[1] + 1, dtype=np.int32), score.shape), axis=1)
    return order, place


def relative(score: np.ndarray) -> dict[str, np.ndarray]:
    """What ``relative_features`` gives for the candidates (columns) of each query (row)."""
    order, place = ranks(score)
    down = np.take_along_axis(score, order, 1)
    n = score.shape[1]
    at = np.arange(n)
    change = down[:, 1:] != down[:, :-1]
    edge = np.ones((len(score), 1), bool)
    first = np.maximum.accumulate(np.where(np.hstack([edge, change]), at, 0), axis=1)
    last = np.minimum.accumulate(np.where(np.hstack([change, edge]), at, n)[:, ::-1], axis=1)[:, ::-1]
    percentile = np.empty(score.shape)
    np.put_along_axis(percentile, order, (n - last + (last - first) / 2) / n, axis=1)
    best, second = down[:, :1], down[:, 1:2] if n > 1 else np.zeros((len(score), 1))
    return {"rank": place, "percentile": percentile, "best_score": best, "candidate_count": np.array([[n]]), "second_best_score": second, "score_gap": best - second}
