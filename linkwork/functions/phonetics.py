"""Phonetic codes of words: the built-in soundex, and the published Metaphone rules in an Arrow UDF."""

from __future__ import annotations

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, StringType

VOWELS = "AEIOU"


def metaphone(word: str) -> str:
    """Metaphone (Philips 1990) of a word's ASCII letters."""
    w = "".join(c for c in word.upper() if "A" <= c <= "Z")
    if not w:
        return ""
    if w[:2] in ("AE", "GN", "KN", "PN", "WR"):
        w = w[1:]
    elif w[0] == "X":
        w = "S" + w[1:]
    elif w[:2] == "WH":
        w = "W" + w[2:]
    out, n, i = [], len(w), 0
    at = lambda k: w[k] if 0 <= k < n else ""
    while i < n:
        c, prev, nxt = w[i], at(i - 1), at(i + 1)
        step = 1
        if c == prev and c != "C":
            i += 1
            continue
        if c in VOWELS:
            if i == 0:
                out.append(c)
        elif c == "B":
            if not (prev == "M" and i == n - 1):
                out.append("B")
        elif c == "C":
            if nxt == "I" and at(i + 2) == "A":
                out.append("X")
            elif nxt == "H":
                out.append("K" if prev == "S" else "X")
                step = 2
            elif nxt and nxt in "IEY":
                if prev != "S":
                    out.append("S")
            else:
                out.append("K")
        elif c == "D":
            if nxt == "G" and at(i + 2) and at(i + 2) in "EIY":
                out.append("J")
                step = 2
            else:
                out.append("T")
        elif c == "G":
            if nxt == "H":
                if not (i + 2 < n and at(i + 2) not in VOWELS):
                    out.append("K" if i == 0 or at(i + 2) in VOWELS and at(i + 2) else "F")
                step = 2
            elif nxt == "N":
                if not (i + 2 == n or w[i + 2 :] == "ED"):
                    out.append("K")
            elif nxt and nxt in "EIY" and prev != "G":
                out.append("J")
            else:
                out.append("K")
        elif c == "H":
            if nxt and nxt in VOWELS and (not prev or prev not in "CGPST"):
                out.append("H")
        elif c == "K":
            if prev != "C":
                out.append("K")
        elif c == "P":
            if nxt == "H":
                out.append("F")
                step = 2
            else:
                out.append("P")
        elif c == "Q":
            out.append("K")
        elif c == "S":
            if nxt == "H":
                out.append("X")
                step = 2
            elif nxt == "I" and at(i + 2) and at(i + 2) in "OA":
                out.append("X")
            else:
                out.append("S")
        elif c == "T":
            if nxt == "I" and at(i + 2) and at(i + 2) in "OA":
                out.append("X")
            elif nxt == "H":
                out.append("0")
                step = 2
            elif not (nxt == "C" and at(i + 2) == "H"):
                out.append("T")
        elif c == "V":
            out.append("F")
        elif c in "WY":
            if nxt and nxt in VOWELS:
                out.append(c)
        elif c == "X":
            out.append("KS")
        elif c == "Z":
            out.append("S")
        else:
            out.append(c)
        i += step
    return "".join(out)


@F.pandas_udf(ArrayType(StringType()))
def metaphones(words: pd.Series) -> pd.Series:
    """The code of each word of a list; each distinct word of a batch is coded once."""
    known: dict[str, str] = {}

    def code(w: str) -> str:
        if w not in known:
            known[w] = metaphone(w)
        return known[w]

    return words.map(lambda ws: None if ws is None else [code(w) for w in ws])


def soundex_or_none(c: Column) -> Column:
    """Soundex of words that begin with an ASCII letter."""
    return F.when(c.rlike("^[A-Za-z]"), F.soundex(c))


def phonetic_codes(words: Column) -> Column:
    """Distinct ``S:`` soundex and ``M:`` metaphone codes of a list of words."""
    s = F.transform(words, lambda t: F.concat(F.lit("S:"), soundex_or_none(t)))
    m = F.transform(metaphones(words), lambda t: F.when(t != "", F.concat(F.lit("M:"), t)))
    return F.array_distinct(F.array_compact(F.concat(s, m)))
