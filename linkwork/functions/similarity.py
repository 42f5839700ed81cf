"""Pairwise similarities. Set and edit measures are built-in expressions; Jaro-Winkler and the indel ratio are Arrow UDFs that score each distinct pair of a batch once."""

from __future__ import annotations

from math import fma

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType


def jaccard(a: Column, b: Column) -> Column:
    """Of two lists taken as sets; 0 where either is empty."""
    both = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) > 0) & (F.size(b) > 0), both / F.size(F.array_union(a, b))).otherwise(F.lit(0.0))


def share_code(a: Column, b: Column) -> Column:
    return F.coalesce(F.arrays_overlap(a, b).cast("double"), F.lit(0.0))


def levenshtein_similarity(a: Column, b: Column, both_empty: float = 0.0) -> Column:
    """1 - distance / longer length; 0 where one side is empty."""
    longer = F.greatest(F.length(a), F.length(b))
    return F.when(longer == 0, F.lit(both_empty)).when((F.length(a) == 0) | (F.length(b) == 0), F.lit(0.0)).otherwise(F.coalesce(1 - F.levenshtein(a, b) / longer, F.lit(0.0)))


def exact(a: Column, b: Column) -> Column:
    return F.coalesce((F.trim(a) == F.trim(b)).cast("double"), F.lit(0.0))


def exact_nonempty(a: Column, b: Column) -> Column:
    return F.coalesce(((a == b) & (a != "")).cast("double"), F.lit(0.0))


def prefix_match(a: Column, b: Column, n: int = 3) -> Column:
    return F.coalesce((F.substring(F.trim(a), 1, n) == F.substring(F.trim(b), 1, n)).cast("double"), F.lit(0.0))


def conflict(a: Column, b: Column) -> Column:
    """Both given and different; missing is no conflict."""
    return F.coalesce((F.trim(a) != F.trim(b)).cast("double"), F.lit(0.0))


def edge_match(a: Column, b: Column, n: int, end: bool) -> Column:
    """Equal first or last n characters of texts at least that long."""
    part = (lambda c: F.right(c, F.lit(n))) if end else (lambda c: F.left(c, F.lit(n)))
    return F.coalesce(((F.length(a) >= n) & (F.length(b) >= n) & (part(a) == part(b))).cast("double"), F.lit(0.0))


def triangular_consistency(x: Column, y: Column, z: Column) -> Column:
    return F.when(x.isNotNull() & y.isNotNull() & z.isNotNull(), F.least(x, y, z)).otherwise(F.lit(0.0))


def jaro_winkler_of(a: str, b: str) -> float:
    """Jaro, with up to four shared first letters counted where it exceeds 0.7; added in one rounding, as DuckDB does."""
    if not a or not b:
        return 0.0
    if a == b:
        return 1.0
    reach = max(max(len(a), len(b)) // 2 - 1, 0)
    used = [False] * len(b)
    hits_a = []
    for i, c in enumerate(a):
        for j in range(max(0, i - reach), min(len(b), i + reach + 1)):
            if not used[j] and b[j] == c:
                used[j] = True
                hits_a.append(c)
                break
    m = len(hits_a)
    if not m:
        return 0.0
    hits_b = [c for c, u in zip(b, used, strict=True) if u]
    swaps = sum(x != y for x, y in zip(hits_a, hits_b, strict=True)) // 2
    j = (m / len(a) + m / len(b) + (m - swaps) / m) / 3
    if j > 0.7:
        k = 0
        while k < min(4, len(a), len(b)) and a[k] == b[k]:
            k += 1
        j = fma(0.1 * k, 1 - j, j)
    return j


def levenshtein_of(a: str, b: str) -> int:
    """Edit distance, on bit vectors."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full, top = (1 << len(a)) - 1, 1 << len(a) >> 1
    up, down, n = full, 0, len(a)
    for c in b if a else ():
        x = where.get(c, 0)
        same = (((x & up) + up) ^ up) | x | down
        plus, minus = down | full & ~(same | up), same & up
        n += (plus & top > 0) - (minus & top > 0)
        plus = plus << 1 | 1
        up, down = (minus << 1 | ~(same | plus)) & full, plus & same & full
    return n if a else len(b)


def lcs(a: str, b: str) -> int:
    """Length of the longest common subsequence, on bit vectors."""
    where: dict[str, int] = {}
    for i, c in enumerate(a):
        where[c] = where.get(c, 0) | 1 << i
    full = (1 << len(a)) - 1
    s = full
    for c in b:
        u = s & where.get(c, 0)
        s = (s + u | s - u) & full
    return len(a) - s.bit_count()


def indel_of(a: str, b: str) -> float:
    """2 LCS / (len a + len b); two empty texts are alike."""
    n = len(a) + len(b)
    return 2 * lcs(a, b) / n if n else 1.0


def token_set_of(a: list, b: list) -> float:
    """Best indel ratio among the common words and the common words with either rest."""
    x, y = set(a), set(b)
    if not x or not y:
        return 0.0
    common = x & y
    da, db = " ".join(sorted(x - y)), " ".join(sorted(y - x))
    if common and (not da or not db):
        return 1.0
    s = len(" ".join(sorted(common)))
    gap = 1 if s else 0
    sa, sb = s + gap + len(da), s + gap + len(db)
    distance = len(da) + len(db) - 2 * lcs(da, db)
    first = 1 - distance / (sa + sb)
    return max(first, 1 - (gap + len(da)) / (s + sa), 1 - (gap + len(db)) / (s + sb)) if s else first


def _cached(f):
    def of(a: pd.Series, b: pd.Series) -> pd.Series:
        known: dict = {}
        out = []
        for x, y in zip(a, b, strict=True):
            x, y = ("" if x is None else x), ("" if y is None else y)
            key = (x, y) if isinstance(x, str) else (tuple(x), tuple(y))
            if key not in known:
                known[key] = f(x, y)
            out.append(known[key])
        return pd.Series(out, dtype="float64")

    return of


@F.pandas_udf(DoubleType())
def jaro_winkler(a: pd.Series, b: pd.Series) -> pd.Series:
    return _cached(jaro_winkler_of)(a, b)


@F.pandas_udf(DoubleType())
def indel_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _cached(indel_of)(a, b)


@F.pandas_udf(DoubleType())
def token_set_ratio(a: pd.Series, b: pd.Series) -> pd.Series:
    return _cached(token_set_of)(a, b)


def token_sort_ratio(a: Column, b: Column) -> Column:
    """Indel ratio of the sorted words; 0 where either has none."""
    text = lambda x: F.array_join(F.array_sort(x), " ")
    return F.when((F.size(a) > 0) & (F.size(b) > 0), indel_ratio(text(a), text(b))).otherwise(F.lit(0.0))


def cosine(a: Column, b: Column) -> Column:
    """Of two dense vectors; 0 where either has no length."""
    dot = lambda x, y: F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)
    size = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when(size > 0, dot(a, b) / size).otherwise(F.lit(0.0))
