"""Normalised records: all views of a source in one projection."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import phonetics, text


def normalize_records(df: DataFrame, id_col: str, fold: bool = True, phonetic: bool = True) -> DataFrame:
    """(id, source) and the views of name and address, with the name's phonetic codes."""
    c = F.col
    keep = [c(id_col).alias("id")] + ([c("source")] if "source" in df.columns else [])
    raw = [c("name").alias("__name"), c("address").alias("__address")]
    # the decomposition comes first, as columns of their own: a lambda can't hold a Python UDF
    plain = [(text.unaccent(c(x).cast("string")) if fold else c(x)).alias(x) for x in ("name", "address", "state", "city", "street_name", "country")]
    df = df.select(*keep, *raw, *plain, "postal_code", "street_number")
    names = text.name_views(c("name"), False) | {"original_name": c("__name")}
    places = text.address_views(c("address"), c("state"), c("city"), c("postal_code"), c("street_number"), c("street_name"), c("country"), False)
    places |= {"original_address": c("__address"), "landmark": text.landmark(c("__address"))}
    out = df.select("id", *(["source"] if "source" in df.columns else []), *[v.alias(k) for k, v in names.items()], *[v.alias(k) for k, v in places.items()])
    return out.withColumn("phonetic_codes", phonetics.phonetic_codes(c("name_tokens"))) if phonetic else out
