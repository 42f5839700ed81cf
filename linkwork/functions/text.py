"""Text normalisation as column expressions; the only UDF is Unicode decomposition, which Spark has no function for."""

from __future__ import annotations

import unicodedata

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

# Abbreviations, legal suffixes and stop words of the record-linkage task.
ABBREVIATIONS = {
    "rd": "road", "rd.": "road",
    "st": "street", "st.": "street",
    "ave": "avenue", "ave.": "avenue",
    "blvd": "boulevard", "blvd.": "boulevard",
    "ln": "lane", "ln.": "lane",
    "dr": "drive", "dr.": "drive",
    "apt": "apartment", "apt.": "apartment",
    "&": "and",
}
LEGAL_SUFFIXES = [
    "pvt ltd", "private limited", "pvt. ltd.", "pvt.ltd.",
    "ltd", "limited", "corp", "corporation", "inc", "incorporated",
    "co", "company", "llc", "llp", "gmbh", "sarl", "sas", "sa",
]
STOPWORDS = ["of", "the", "a", "an"]
LANDMARK = r"(?i)\b(near|opp\.?|opposite|behind|next to)\b.*"
STREET_NUMBER = r"^\s*(\d+[a-zA-Z]?)\b"
SPACES = r"(?U)\s+"


def _escape(s: str) -> str:
    return "".join("\\" + c if not c.isalnum() and c != " " else c for c in s)


@F.pandas_udf(StringType())
def unaccent(s: pd.Series) -> pd.Series:
    """Compatibility decomposition without combining marks."""
    fold = lambda x: x if x is None or x.isascii() else "".join(c for c in unicodedata.normalize("NFKD", x) if not unicodedata.combining(c))
    return s.map(fold)


def is_missing(c: Column) -> Column:
    """Null, NaN or nothing but white space."""
    return c.isNull() | (F.regexp_replace(c.cast("string"), SPACES, "") == "") | (c.cast("string") == "NaN")


def text_or_empty(c: Column) -> Column:
    return F.when(is_missing(c), F.lit("")).otherwise(c.cast("string"))


def clean(c: Column, fold: bool = True) -> Column:
    """Decomposed, lower-cased, trimmed, one space between words; missing is empty."""
    x = text_or_empty(c)
    x = unaccent(x) if fold else x
    return F.regexp_replace(F.regexp_replace(F.lower(x), r"(?U)^\s+|\s+$", ""), SPACES, " ")


def tokens(c: Column) -> Column:
    """Words in order, repeats kept."""
    return F.filter(F.split(c, SPACES), lambda t: t != "")


def expand_abbreviations(c: Column) -> Column:
    names = F.create_map(*[F.lit(x) for kv in ABBREVIATIONS.items() for x in kv])
    return F.array_join(F.transform(tokens(c), lambda t: F.coalesce(F.element_at(names, t), t)), " ")


def strip_punctuation(c: Column, keep_spaces: bool = True) -> Column:
    return F.regexp_replace(c, r"(?U)[^\p{L}\p{N}_\s]" if keep_spaces else r"[^\p{L}\p{N}_]", " " if keep_spaces else "")


def compact(c: Column) -> Column:
    return F.regexp_replace(F.lower(c), "[^a-z0-9]", "")


def char_ngrams(c: Column, n: int) -> Column:
    """Distinct n-grams of the text without spaces; the text itself where it is shorter; none of an empty one."""
    s = F.regexp_replace(c, " ", "")
    size = F.length(s)
    grams = F.array_distinct(F.transform(F.sequence(F.lit(1), F.greatest(size - n + 1, F.lit(1))), lambda i: F.substring(s, i, F.lit(n))))
    return F.when(size == 0, F.array().cast("array<string>")).when(size < n, F.array(s)).otherwise(grams)


def remove_legal_suffix(c: Column) -> Column:
    """Without one legal form at its end, the longest that fits."""
    forms = "|".join(_escape(s) for s in sorted(LEGAL_SUFFIXES, key=len, reverse=True))
    return F.trim(F.regexp_replace(c, f"(^| )({forms})$", ""))


def remove_stopwords(c: Column) -> Column:
    return F.array_join(F.filter(tokens(c), lambda t: ~t.isin(STOPWORDS)), " ")


def name_views(c: Column, fold: bool = True) -> dict[str, Column]:
    """The views of a name: chained columns, each on top of the normalised one."""
    norm = expand_abbreviations(strip_punctuation(clean(c, fold)))
    return {
        "original_name": c,
        "normalized_name": norm,
        "name_without_suffix": remove_legal_suffix(norm),
        "compact_name": compact(norm),
        "name_tokens": tokens(norm),
        "stopword_removed": remove_stopwords(norm),
        "char_3grams": char_ngrams(norm, 3),
        "char_4grams": char_ngrams(norm, 4),
        "char_5grams": char_ngrams(norm, 5),
        "name_missing": is_missing(c),
    }


def clean_code(c: Column) -> Column:
    """A code without the decimal tail that type inference gives it; missing is null."""
    return F.when(~is_missing(c), F.regexp_replace(F.trim(c.cast("string")), r"\.0$", ""))


def landmark(c: Column) -> Column:
    return F.when(~is_missing(c), F.nullif(F.trim(F.regexp_extract(c, LANDMARK, 0)), F.lit("")))


def street_number(norm: Column) -> Column:
    return F.nullif(F.regexp_extract(norm, STREET_NUMBER, 1), F.lit(""))


def _place(c: Column, fold: bool) -> Column:
    return F.when(~is_missing(c), clean(c, fold))


def address_views(address: Column, state: Column, city: Column, postal: Column, number: Column, street: Column, country: Column, fold: bool = True) -> dict[str, Column]:
    base = F.trim(F.regexp_replace(text_or_empty(address), LANDMARK, ""))
    norm = expand_abbreviations(strip_punctuation(clean(base, fold)))
    parsed = street_number(norm)
    return {
        "original_address": address,
        "normalized_address": norm,
        "address_tokens": tokens(norm),
        "landmark": landmark(address),
        "postal_code": clean_code(postal),
        "city": _place(city, fold),
        "state": _place(state, fold),
        "country": _place(country, fold),
        "street_name": _place(street, fold),
        "street_number": F.coalesce(clean_code(number), parsed),
        "address_missing": is_missing(address),
        "postal_missing": is_missing(postal),
        "city_missing": is_missing(city),
        "state_missing": is_missing(state),
        "street_number_missing": is_missing(number) & parsed.isNull(),
    }
