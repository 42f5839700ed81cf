"""Document fingerprints after I-Match, with DataFrame functions only.

Document frequencies are counted for each term by its 64-bit hash. The lexicon is
the band of inverse document frequency, and it is applied by what lies outside:
terms over the band are few (at most the mean number of a document's terms over
MOST) and broadcast up to a checked size; a term of a single document travels to
that document as one of its list of rare terms; terms that an edited text has and
neither of its sources has (words cut at a seam) are looked up in the frequencies.
So no shuffle carries the terms of the texts a second time. A text's distinct terms are
sorted and those of the lexicon kept (of a text with at most 32 terms, all);
several randomised subsets of the lexicon each give one hash of the set of kept
terms that fall in them. How dense the subsets are goes by the number of the
text's terms, at two neighbouring levels, so that about one term falls in each:
a subset's hash then outlives edits elsewhere in the text.

The likeness of two fingerprints is the share of equal hashes among the subsets
of common levels in which either has terms.

Documents stand in ranges of descending ids, each range with a copy of the next
one's first row, so that one shuffle serves all steps: the next document, the
edited text, the terms, and the next fingerprint.

Defined results: a null text is empty; empty texts have the fingerprint "0" and
likeness 1 to each other, 0 to others; equal texts have equal fingerprints;
rows of equal id follow each other in order of their texts' hashes; null ids
come last; ids of any type that can be ordered; a single document is its own next; other columns are not looked at.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from .common import materialise, shared_dir, texts

#: Terms over the band that are broadcast, at most; beyond, they are joined by a shuffle.
BROADCAST = 1 << 20
#: The band: at least this many documents, at most this share of them.
LEAST, MOST = 2, 0.05
#: Randomised subsets at each level.
SUBSETS = 12
#: Terms are runs of letters, digits and non-ASCII characters.
_SPLIT = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def _terms(text: Column) -> Column:
    """The hashes (long) of the sorted distinct terms."""
    words = F.array_remove(F.array_sort(F.array_distinct(F.split(F.lower(text), _SPLIT))), "")
    return F.transform(words, lambda t: F.xxhash64(t))


def frequencies(docs: DataFrame, least: int = LEAST) -> DataFrame:
    """(h, n, ref): each term's hash and number of documents; of a term of fewer than ``least``, its document. A written table.

    ``docs`` has text and ref, a long for each distinct row.
    """
    terms = docs.select("ref", F.explode(_terms(F.col("text"))).alias("h"))
    count = terms.groupBy("h").agg(F.count("*").alias("n"), F.min("ref").alias("ref"))
    return materialise(count.select("h", "n", F.when(F.col("n") < least, F.col("ref")).alias("ref")))


def _mask(level: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), level) - 1


def _in_subset(h: Column, k: int, mask: Column) -> Column:
    return F.xxhash64(h, F.lit(k)).bitwiseAND(mask) == 0


def _name(h: Column, k: int) -> Column:
    return F.xxhash64(h, F.lit(k + 1000))


def _sum_of(terms: Column, k: int, mask: Column) -> Column:
    """The exclusive or of the names of the terms (an array) in a subset; 0 where there are none."""
    zero = F.lit(0).cast("long")
    return F.aggregate(terms, zero, lambda acc, h: acc.bitwiseXOR(F.when(_in_subset(h, k, mask), _name(h, k)).otherwise(zero)))


def _slots() -> list[tuple[int, int]]:
    return [(k, i) for k in range(SUBSETS) for i in (0, 1)]


def _subset_sums() -> Column:
    """For each subset and level, the exclusive or of the hashes of the kept terms in it; null where there are none."""
    h = F.col("h")
    return F.array(*[F.bit_xor(F.when(h.isNotNull() & _in_subset(h, k, F.col(("coarse", "fine")[i])), _name(h, k))) for k, i in _slots()]).alias("sums")


def _hashes(which: str, found: Column | None = None) -> Column:
    """Array of "level.subset.hash" of the subsets that have terms; ``found`` are further terms to be taken in."""
    out = []
    for j, (k, i) in enumerate(_slots()):
        x, level = F.coalesce(F.col(f"{which}.sums")[j], F.lit(0).cast("long")), F.col(f"{which}.level")
        if found is not None:
            x = x.bitwiseXOR(_sum_of(found, k, _mask(level + i)))
        out.append(F.when(x != 0, F.concat((level + i).cast("string"), F.lit(f".{k}."), F.substring(F.lower(F.hex(x)), -8, 8))))
    return F.array_compact(F.array(*out))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal hashes among the subsets of common levels in which either has terms."""
    slot = lambda x: F.substring_index(x, ".", 2)
    level = lambda xs: F.array_distinct(F.transform(xs, lambda x: F.substring_index(x, ".", 1)))
    common = F.array_intersect(level(a), level(b))
    both = F.filter(F.array_union(a, b), lambda x: F.array_contains(common, F.substring_index(x, ".", 1)))
    n = F.size(F.array_distinct(F.transform(both, slot)))
    same = F.size(F.array_intersect(a, b))
    return F.when((F.size(a) == 0) & (F.size(b) == 0), F.lit(1.0)).when(n > 0, same / n).otherwise(F.lit(0.0))


def _place(key: DataFrame) -> Column:
    """A number that never falls as the id rises: the id itself, or of other types the first six bytes of its text."""
    if key.schema["id"].dataType.typeName() in ("byte", "short", "integer", "long", "float", "double", "decimal", "date", "timestamp"):
        return F.col("id")
    return F.conv(F.rpad(F.substring(F.hex(F.encode(F.col("id").cast("string"), "UTF-8")), 1, 12), 12, "0"), 16, 10).cast("long")


def fingerprints(docs: DataFrame, id_col: str = "doc_id", ranges: int | None = None, least: int = LEAST, most: float = MOST) -> DataFrame:
    """Per document row: n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    ``least`` is 1 or 2: more than one document's terms are no list of one document.
    """
    if least not in (1, 2):
        raise ValueError(f"least must be 1 or 2: {least}")
    spark = docs.sparkSession
    shared_dir(spark)
    key = texts(docs, id_col).select("id", F.coalesce("text", F.lit("")).alias("text"))
    key = key.select("*", F.xxhash64("text").alias("hash"), F.xxhash64("id", "text").alias("ref"))
    count = frequencies(key, least)
    over = F.col("n") > max(least, most * key.count())
    hot = count.where(over).select(F.col("h").alias("slot"))
    rare = count.where("ref is not null").groupBy("ref").agg(F.collect_list("h").alias("rare"))
    ranges = ranges or min(256, 4 * int(spark.conf.get("spark.sql.shuffle.partitions")))
    place = _place(key)
    cut = key.select(F.percentile_approx(place, [i / ranges for i in range(1, ranges)], 10_000).alias("q")).first().q or []
    cut = sorted(set(cut), reverse=True)
    number = F.lit(len(cut))  # ids over the first bound stand in range 0, nulls in the last
    for i, x in reversed(list(enumerate(cut))):
        number = F.when(place > x, i).otherwise(number)
    key = key.withColumn("part", number.cast("int"))
    first = sorted((r.part, r.id) for r in key.groupBy("part").agg(F.max("id").alias("id")).collect())
    ghost = None
    for i, (p, x) in enumerate(first):
        cond = (F.col("part") == p) & F.col("id").eqNullSafe(F.lit(x))
        ghost = F.when(cond, F.lit(first[i - 1][0])) if ghost is None else ghost.when(cond, F.lit(first[i - 1][0]))
    places = F.array(F.struct(F.col("part").alias("p"), F.lit(0).alias("ghost")), F.struct(ghost.alias("p"), F.lit(1).alias("ghost"))) if ghost is not None else F.array(F.struct(F.col("part").alias("p"), F.lit(0).alias("ghost")))
    # the list of a document's rare terms stands right before it, in every range that has the document
    lists = key.select("ref", "id", "hash", "part").join(rare, "ref")
    rows = key.select("id", "hash", "part", "text", F.lit(None).cast("array<bigint>").alias("rare"))
    rows = rows.unionByName(lists.select("id", "hash", "part", F.lit(None).cast("string").alias("text"), "rare"))
    rows = rows.select("id", "hash", "text", "rare", F.explode(F.filter(places, lambda x: x.p.isNotNull())).alias("at")).select("id", "hash", "text", "rare", F.col("at.p").alias("part"), F.col("at.ghost").alias("ghost"))
    order = Window.partitionBy("part").orderBy("ghost", F.col("id").desc_nulls_last(), "hash", F.col("text").asc_nulls_first())
    none = F.array().cast("array<bigint>")
    rows = rows.select(
        "*",
        F.row_number().over(order).alias("row"),
        F.coalesce(F.lead("text").over(order), F.lead("text", 2).over(order), F.lit("")).alias("next"),
        F.coalesce(F.lag("rare").over(order), none).alias("own_rare"),
        F.coalesce(F.lead("rare").over(order), none).alias("next_rare"),
    ).where("text is not null")
    n, k = F.length("text"), F.floor(F.length("text") / 3).cast("int")
    edited = F.concat(F.substring(F.col("text"), F.lit(1), n - k), F.substring(F.col("next"), F.lit(1), k))
    rows = rows.select("part", "row", "ghost", "id", n.alias("n"), "text", "next", edited.alias("edited"), "own_rare", "next_rare")
    rows = rows.select("part", "row", "ghost", "id", "n", F.unhex(F.sha2("edited", 256)).alias("sha"), _terms(F.col("text")).alias("own"), _terms(F.col("next")).alias("after"), _terms(F.col("edited")).alias("new"), "own_rare", "next_rare")
    seam = F.array_except("new", F.concat("own", "after"))
    one = lambda which, all_, drop, cut: F.struct(F.lit(which).alias("which"), F.col(all_).alias("all"), drop.alias("drop"), cut.alias("cut"))
    two = F.array(one(0, "own", F.col("own_rare"), none), one(1, "new", F.concat("own_rare", "next_rare"), seam))
    rows = rows.select("part", "row", "ghost", "id", "n", "sha", F.explode(two).alias("x")).where("x.which = 0 or ghost = 0")
    few = F.size("x.all") <= 32
    level = F.floor(F.log2(F.greatest(F.size("x.all"), F.lit(1)))).cast("int")
    rows = rows.select("part", "row", F.col("x.which").alias("which"), "ghost", "id", "n", "sha", level.alias("level"), few.alias("few"), F.when(few, none).otherwise(F.col("x.cut")).alias("cut"), F.when(few, F.col("x.all")).otherwise(F.array_except("x.all", F.concat("x.drop", "x.cut"))).alias("kept"))
    key_cols = ["part", "row", "which", "ghost", "id", "n", "sha", "level", "cut"]
    # the first row of each text is a mark without a term, so that texts without lexicon terms stay
    rows = rows.select(*key_cols, "few", _mask(F.col("level")).alias("coarse"), _mask(F.col("level") + 1).alias("fine"), F.explode(F.concat(F.array(F.lit(None).cast("long")), "kept")).alias("h"))
    rows = rows.withColumn("slot", F.when(~F.col("few"), F.col("h")))
    sums = materialise(rows.join(F.broadcast(hot) if hot.count() <= BROADCAST else hot.hint("merge"), "slot", "left_anti").groupBy(*key_cols).agg(_subset_sums()))
    band = count.where(F.col("ref").isNull() & ~over).select("h")
    found = sums.select("part", "row", F.explode("cut").alias("h")).join(band, "h").groupBy("part", "row").agg(F.collect_list("h").alias("found"))
    both = sums.select("part", "row", F.when(F.col("which") == 0, F.struct("ghost", "id", "n")).alias("meta"), F.when(F.col("which") == 0, F.struct("sums", "level")).alias("own"), F.when(F.col("which") == 1, F.struct("sums", "level", "sha")).alias("new"))
    both = both.unionByName(found, allowMissingColumns=True).repartition("part")
    pair = both.groupBy("part", "row").agg(*[F.first(c, ignorenulls=True).alias(c) for c in ("meta", "own", "new", "found")])
    pair = pair.select("part", "row", "meta", F.lower(F.hex("new.sha")).alias("sha"), _hashes("own").alias("fp"), _hashes("new", F.coalesce("found", none)).alias("edited_fp"))
    pair = pair.withColumn("next_fp", F.lead("fp").over(Window.partitionBy("part").orderBy("row"))).where("meta.ghost = 0")
    text_of = lambda fp: F.when(F.size(fp) > 0, F.array_join(fp, ",")).otherwise(F.lit("0"))
    return pair.select(
        F.col("meta.id").alias(id_col),
        F.col("meta.n").cast("long").alias("n_chars"),
        F.col("sha").alias("edited_sha256"),
        text_of(F.col("fp")).alias("fingerprint"),
        text_of(F.col("edited_fp")).alias("edited_fingerprint"),
        likeness(F.col("fp"), F.col("edited_fp")).alias("near_edited"),
        likeness(F.col("fp"), F.col("next_fp")).alias("near_next"),
    )
