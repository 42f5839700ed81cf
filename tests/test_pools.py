"""Pool features against plain ones, and the queries that use them against their SQL."""

import math
import random

import duckdb
import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F
from test_linkage import test_queries_match_sql as match_sql

from linkwork.functions.similarity import jaro_winkler_of
from linkwork.operators import blocking, evaluation, features, models, pooled_models, pools, tfidf
from linkwork.queries import QUERIES, linkage

POOLED = ["cheap_features", "cheap_rank_fallback", "cheap_topk", "feat_contradiction", "feat_address", "feat_name", "feat_missing", "feat_crossfield", "feat_relative", "hard_negatives", "sample_weights", "hand_rule", "macro_f05", "matching_idlist", "validate_long", "best_threshold", "error_categories", "prune_topk"]
#: Those whose plans made pairs and shuffled them.
UNSHUFFLED = ["cheap_features", "cheap_rank_fallback", "feat_contradiction", "feat_address", "feat_name", "feat_missing", "feat_crossfield", "hard_negatives", "sample_weights"]


@pytest.mark.parametrize("name", POOLED)
def test_pooled_queries_match_sql(spark, sf, name):
    match_sql(spark, sf, name)


@pytest.mark.parametrize("name", UNSHUFFLED)
def test_no_pair_is_shuffled(spark, sf, name):
    """No exchange is dealt by the pair's ids."""
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    dealt = [line for line in plan.splitlines() if "hashpartitioning" in line]
    assert dealt and not [line for line in dealt if "hashpartitioning(s1#" in line or "hashpartitioning(rid#" in line]


def test_jaro_winkler_of_many():
    r = random.Random(3)
    text = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    a = [text("ab c", r.randrange(12)) for _ in range(60)] + [text("abcdefgh ij", r.randrange(20, 70)) for _ in range(60)] + ["", "\u00e9\0x", "a" * 64, "a" * 65]
    b = [text("ab c", r.randrange(12)) for _ in range(90)] + [text("abcdefgh ij", r.randrange(20, 75)) for _ in range(90)] + a[::3]
    assert np.array_equal(pools.Texts(b).jaro_winkler(a), [[jaro_winkler_of(x, y) for y in b] for x in a])


def test_levenshtein_of_many():
    """candidates of more letters than a bit vector has, and empty texts, too."""
    r = random.Random(7)
    text = lambda letters, n: "".join(r.choice(letters) for _ in range(n))
    a = [text("ab c", r.randrange(12)) for _ in range(40)] + [text("abcdefgh ij", r.randrange(20, 90)) for _ in range(40)] + ["", "a" * 64, "a" * 65]
    b = [text("ab c", r.randrange(12)) for _ in range(60)] + [text("abcdefgh ij", r.randrange(20, 90)) for _ in range(60)] + a[::3]
    n = dict(((x, y), d) for x, y, d in duckdb.sql("SELECT a, b, levenshtein(a, b) FROM (SELECT unnest($a) AS a) CROSS JOIN (SELECT unnest($b) AS b)", params={"a": a, "b": b}).fetchall())
    for both in (0.0, 1.0):
        want = [[1 - n[x, y] / max(len(x), len(y)) if x and y else both * (x == y) for y in b] for x in a]
        assert pools.Texts(b).levenshtein(a, both).tolist() == want


def test_jaro_winkler_to_the_last_bit_of_sql():
    """the shared first letters are added in one rounding, which products that are halves and thresholds tell."""
    words = "alpha beta gamma of the to delta near road and in is a".split()
    r = random.Random(1)
    text = lambda: " ".join(r.choice(words) for _ in range(r.randrange(1, 7)))
    a, b = sorted({text() for _ in range(90)}), sorted({text() for _ in range(200)})
    known = duckdb.sql("SELECT jaro_winkler_similarity(a, b) FROM (SELECT unnest($a) AS a) CROSS JOIN (SELECT unnest($b) AS b) ORDER BY a, b", params={"a": a, "b": b}).fetchall()
    want = np.array(known).reshape(len(a), len(b))
    assert np.array_equal(pools.Texts(b).jaro_winkler(a), want)
    assert [[jaro_winkler_of(x, y) for y in b] for x in a] == want.tolist()
    rng = np.random.default_rng(0)
    x, y, z = rng.integers(0, 5, 20000) * 0.1, rng.random(20000), rng.random(20000)
    assert pools.fused(x, y, z).tolist() == [math.fma(*v) for v in zip(x, y, z, strict=True)]


def test_pool_features_in_chunks(spark, sf, monkeypatch):
    """Small chunks and blocks give what whole ones and the features of attached pairs give; missing values are never equal."""
    a, b = linkage.records(spark, sf)
    geo = linkage.geo(a, b)
    plain = blocking.cheap_features(blocking.attach(blocking.geo_pool(*geo), a, b), phonetic=False).drop("phonetic_match")
    want = sorted(map(tuple, plain.collect()))
    monkeypatch.setattr(pools, "CHUNK", 7)
    monkeypatch.setattr(pools, "BLOCK", 3)
    got = pools.pool_features(*geo, a, b).select(*plain.columns)
    assert sorted(map(tuple, got.collect())) == want


def test_cross_source_of_pools(spark):
    """What pairs give, with copies and ties, once a key; candidates of a key without the other source have no support."""
    names = [("2a", "S2", "blue hill"), ("2b", "S2", "blue hill"), ("2c", "S2", ""), ("2d", "S2", "zz"), ("3a", "S3", "blue hills"), ("3b", "S3", "blue bill"), ("3c", "S3", "blue hall"), ("3d", "S3", "")]
    b = spark.createDataFrame(names, "id string, source string, normalized_name string")
    queries = spark.createDataFrame([("q1", "x"), ("q2", "x"), ("q3", "y")], "id string, geo_key string")
    places = spark.createDataFrame([(r[0], "x") for r in names] + [("2a", "y"), ("2d", "y")], "id string, geo_key string")
    pairs = blocking.geo_pool(queries, places).join(b.select(F.col("id").alias("rid"), "source"), "rid")
    rows = lambda d: sorted((r.s1, r.rid, round(r.cross_source_support, 9), r.neighbor_match_count) for r in d.collect())
    got = features.cross_source_of_pools(queries, places, b)
    assert rows(got) == rows(features.cross_source_features(pairs, b)) and got.count() == 18
    assert "normalized_name" not in "".join(x for x in got._jdf.queryExecution().executedPlan().toString().splitlines() if "hashpartitioning(s1#" in x)


def test_sweep_by_counts(spark):
    labels = spark.createDataFrame([("a", "1", 1), ("a", "2", 0), ("b", "1", 1), ("c", "9", 1)], "s1 string, rid string, label int")
    scores = spark.createDataFrame([("a", "1", 0.55), ("a", "2", 0.9), ("b", "1", 0.01), ("d", "4", 0.049)], "s1 string, rid string, score double")
    labelled = scores.join(labels, ["s1", "rid"], "left").na.fill(0)
    rows = lambda d: [tuple(r) for r in d.collect()]
    assert rows(evaluation.sweep_threshold(labelled, labels)) == rows(evaluation.sweep_threshold(scores, labels))


@pytest.mark.parametrize("name", ["topk_token", "topk_char4", "topk_concat"])
def test_no_row_is_made_for_a_shared_item(spark, sf, name):
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "geo_key" in plan and "item#" not in plan


def test_channels_are_counted_without_the_pool(spark, sf, monkeypatch):
    monkeypatch.setattr(blocking, "geo_pool", lambda *a: pytest.fail("all pairs are made"))
    QUERIES["channel_contribution"](spark, sf)


def test_dense_topk_keeps_the_best_of_a_task(spark, sf):
    plan = QUERIES["dense_cosine_topk"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan
    rng = np.random.default_rng(2)
    rows = np.concatenate([rng.normal(size=(300, 8)), np.tile(rng.normal(size=8), (200, 1)), np.zeros((3, 8))])[rng.permutation(503)]
    unit = tfidf._units(pa.array(rows.tolist()))
    ids = np.arange(503)
    best = tfidf._Best(ids[::7], unit[::7], 5)
    for i in range(0, 503, 40):
        best.add(ids[i : i + 40], unit[i : i + 40])
    got = {}
    for q, r in zip(best.q.tolist(), best.rid.tolist(), strict=True):
        got.setdefault(q, []).append(r)
    score = np.round(unit @ unit.T, 6)
    for n, q in enumerate(ids[::7].tolist()):
        assert got[n] == sorted((r for r in range(503) if r != q), key=lambda r: (-score[q, r], r))[:5]


@pytest.mark.parametrize("name", ["feat_relative", "hand_rule", "macro_f05", "prune_topk"])
def test_no_pair_is_shuffled_for_a_rank(spark, sf, name):
    """Pairs are neither dealt nor sorted: what is dealt by entity are counts."""
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().executedPlan().toString().splitlines()
    assert not [x for x in plan if "Window" in x or "hashpartitioning(s1#" in x and "rid#" in x]
    dealt = [x for x in plan if "hashpartitioning(s1#" in x]
    assert not dealt or name == "macro_f05" and not [x for x in plan if "keys=[s1#" in x and "rid#" in x]


def test_relative_of_rows():
    rng = np.random.default_rng(1)
    for n in (1, 2, 60):
        score = rng.integers(0, 6, (5, n)) / 4
        got = pools.relative(score)
        for i, x in enumerate(score):
            order = sorted(range(n), key=lambda j: (-x[j], j))
            assert [int(got["rank"][i, j]) for j in order] == list(range(1, n + 1))
            assert np.allclose(got["percentile"][i], [(np.sum(x < v) + 1 + (np.sum(x == v) - 1) / 2) / n for v in x])
            top = [*sorted(x)[::-1], 0.0]
            assert (got["best_score"][i, 0], got["second_best_score"][i, 0]) == (top[0], top[1])


def test_rounded_as_spark(spark):
    x = np.concatenate([np.arange(4000) / 1024 + 0.0, np.random.default_rng(4).random(3000), (np.arange(3000) * 2 + 1) / 2e9, (np.arange(3000) * 2 + 1) / 2e6])
    for places in (6, 9):
        want = spark.createDataFrame(pa.table({"x": x})).select(F.round("x", places)).toArrow().column(0).to_numpy()
        assert np.array_equal(pools.rounded(x, places), want)


def test_rounded_as_sql():
    """of the binary product with the power of ten, which for 0.12481249999999999 is a half."""
    rng = np.random.default_rng(4)
    x = np.concatenate([rng.random(3000), (np.arange(3000) * 2 + 1) / 2e6, rng.integers(0, 1000, 9000) / 1001 * rng.integers(1, 8, 9000) / 8, [0.12481249999999999]])
    for places in (6, 9):
        want = duckdb.sql(f"SELECT round(unnest($x), {places})", params={"x": x.tolist()}).fetchall()
        assert pools.rounded_sql(x, places).tolist() == [v for (v,) in want]


def test_rows_in_chunks(spark, sf, monkeypatch):
    """Small chunks and blocks change no rank; ties of the pruning score to six places go to the first id."""
    want = {n: sorted(map(tuple, QUERIES[n](spark, sf).collect())) for n in ("feat_relative", "prune_topk")}
    monkeypatch.setattr(pools, "CHUNK", 7)
    monkeypatch.setattr(pools, "ROOM", 50)
    for n, rows in want.items():
        assert sorted(map(tuple, QUERIES[n](spark, sf).collect())) == rows


def test_macro_f05_counted(spark):
    labels = spark.createDataFrame([("a", "1", 1), ("a", "2", 0), ("b", "1", 1), ("c", "9", 0)], "s1 string, rid string, label int")
    found = spark.createDataFrame([("a", "1", 1), ("a", "2", 0), ("d", "4", 0)], "s1 string, rid string, label int")
    assert evaluation.macro_f05_counted(found, labels).collect() == evaluation.macro_f05(found, labels).collect()
    none = evaluation.macro_f05_counted(found.limit(0), labels.limit(0)).collect()
    assert none == evaluation.macro_f05(found.limit(0), labels.limit(0)).collect() and len(none) == 1


def random_pairs(spark, n=3000):
    """(s1, rid, fold, features, label) with few distinct values, so that most pairs have equals."""
    rng = np.random.default_rng(5)
    x = np.stack([rng.integers(0, 60, n) / 64, rng.integers(0, 9, n) / 8, rng.integers(0, 2, n)], 1)
    label = (x[:, 0] + 0.3 * x[:, 1] + 0.2 * rng.random(n) > 0.9).astype(int)
    return spark.createDataFrame([(f"S1-{i % 30}", f"S2-{i}", i % 30 % 3, *map(float, x[i]), int(label[i])) for i in range(n)], "s1 string, rid string, fold int, a double, b double, c double, label int")


class Listed:
    """Stands for ``pools.Pairs``: the pairs of a table, a block of one query after the other."""

    def __init__(self, df):
        self.both, self.rows_of = df, df.orderBy("s1", "rid").toPandas()

    def blocks(self):
        for _, x in self.rows_of.groupby("s1"):
            yield x, {c: x[c].to_numpy()[None, :] for c in "abc"} | {"label": x.label.to_numpy()[None, :], "fold": np.array([[x.fold.iloc[0]]])}

    def counts(self, codes):
        every = np.concatenate([np.broadcast_to(c, (1, len(x))).ravel() for x, cols in self.blocks() for c in codes(cols)])
        code, n = np.unique(every, return_counts=True)
        return self.both.sparkSession.createDataFrame(list(zip(code.tolist(), n.tolist(), strict=True)), "code long, n long")

    def rows(self, finish, schema):
        return {(x.s1.iloc[0], r): float(v) for x, cols in self.blocks() for r, v in zip(x.rid, np.broadcast_to(list(finish(cols)[0].values())[-1], (1, len(x)))[0], strict=True)}


def spaced(df):
    return pooled_models.PairSpace(Listed(df), {"a": 64, "b": 8, "c": 1}, lambda c: [c["a"], c["b"], c["c"]], lambda c: c["label"])


def close(got, rows, name, by=1e-9):
    want = {(r.s1, r.rid): r[name] for r in rows.collect()}
    assert got.keys() == want.keys() and max(abs(got[k] - want[k]) for k in want) < by


def test_models_of_counted_pairs_are_those_of_all(spark):
    """MLlib over all rows gives the same scores, calibrations and entity scores as over counted cells."""
    df = random_pairs(spark).persist()
    make = lambda: models.get_pair_model("gbt", trees=3)
    oof = models.run_oof(df, df.select("s1", "fold").distinct(), make).persist()
    space = spaced(df)
    scorer, known = space.oof(make)
    assert known["n"].sum() == 3000 and len(known["n"]) < 2000
    close(space.scored(scorer, "p"), oof, "oof_score")
    for method, by in (("platt", 1e-5), ("isotonic", 1e-9)):
        close(space.scored(space.calibrated(scorer, known, method), "p"), models.Calibrator(method).fit(oof, "oof_score").transform(oof, "oof_score", "p"), "p", by)


def test_split_points_as_mllib():
    """Between all values, or nearest to equal shares of the rows."""
    assert pooled_models.split_points(np.array([0, 3, 4]), np.array([1, 1, 1])).tolist() == [1.5, 3.5]
    assert pooled_models.split_points(np.arange(6), np.array([10, 1, 1, 1, 1, 10]), 3).tolist() == [0.5, 4.5]


def test_entity_model_of_counted_pairs_is_that_of_all(spark):
    """MLlib over all rows, of values in the same steps, gives the same entity scores as over counted cells."""
    df = random_pairs(spark).persist()
    space = spaced(df)
    space.steps = {"jaro_winkler": 64, "address_similarity": 8, "c": 1}
    scorer, _ = space.oof(lambda: models.get_pair_model("gbt", trees=3))
    scores = spark.createDataFrame([(*k, v) for k, v in space.scored(scorer, "p").items()], "s1 string, rid string, pair_score double")
    rows = features.relative_features(df.withColumnsRenamed({"a": "jaro_winkler", "b": "address_similarity"}).join(scores, ["s1", "rid"]), "pair_score")
    rows = rows.withColumns({c: F.rint(F.col(c) * pooled_models.GRID) for c in ("pair_score", "best_score", "second_best_score", "score_gap")}).persist()
    make = lambda: models.entity_model(trees=3)
    close(space.entity_scored(scorer, make), make().fit(rows).score(rows, "e"), "e")


@pytest.mark.parametrize("name", ["calibrate_platt", "calibrate_isotonic", "entity_model"])
def test_no_pair_is_stored_to_learn_from(spark, sf, name):
    """only records are stored; pairs are made of them for the output, and each gets a value from 0 to 1."""
    df = QUERIES[name](spark, sf)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "MapInArrow" in plan.split("InMemoryTableScan")[0]
    rows = df.collect()
    assert len(rows) == QUERIES["geo_pool"](spark, sf).count() and all(0 <= r[2] <= 1 for r in rows)


def test_sweep_makes_no_row_of_a_pair(spark, sf, monkeypatch):
    """thresholds are counted where the pairs are made; counts by query are those of the pairs."""
    monkeypatch.setattr(linkage, "_scored", lambda *a, **b: pytest.fail("pairs become rows"))
    monkeypatch.setattr(linkage, "_er_labels", lambda *a: pytest.fail("true pairs become rows"))
    QUERIES["best_threshold"](spark, sf)
    score, label = np.array([[0.05, 0.051, 0.9, 0.04], [0.95, 1.0, 0.0, 0.2]]), np.array([[1, 0, 1, 1], [0, 1, 1, 0]], bool)
    steps = evaluation.thresholds()
    got = evaluation.reached(score, label, steps)
    assert got["np"].tolist() == [[int(sum(x >= t)) for t in steps] for x in score]
    assert got["tp"].tolist() == [[int(sum(x[y] >= t)) for t in steps] for x, y in zip(score, label, strict=True)]


@pytest.mark.parametrize("name", ["feat_relative", "feat_cross_source", "feat_name", "feat_address", "cheap_features"])
def test_no_pair_is_rounded_or_compared_in_spark(spark, sf, name):
    """what comes out of the pairs is written as it is."""
    plan = QUERIES[name](spark, sf)._jdf.queryExecution().optimizedPlan().toString()
    made = plan.splitlines()[:2] if name == "feat_cross_source" else plan.split("MapInArrow")[0].splitlines()
    assert not [x for x in made if "round(" in x] and "levenshtein(" not in plan


def test_rare_tokens_make_no_row_each(spark, sf):
    """shared tokens are summed where the pairs meet, and pairs of the pool are not dealt by their ids."""
    plan = QUERIES["topk_rare_token"](spark, sf)._jdf.queryExecution().executedPlan().toString()
    assert "item#" not in plan


def test_provenance_of_pools(spark):
    found = spark.createDataFrame([("q1", "a", "token"), ("q1", "a", "rare_token"), ("q2", "b", "char_ngram")], "s1 string, rid string, channel string")
    queries = spark.createDataFrame([("q1", "x"), ("q2", "x"), ("q3", "y")], "id string, geo_key string")
    places = spark.createDataFrame([("a", "x"), ("b", "x"), ("c", "y")], "id string, geo_key string")
    want = blocking.provenance(found, blocking.geo_pool(queries, places))
    got = blocking.provenance_of_pools(found, queries, places).select(*want.columns)
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and got.count() == 5
