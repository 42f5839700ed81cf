"""Golden rows of the linkage operators, and their queries against the SQL twins."""

import duckdb
import pytest
from pyspark.sql import functions as F

from linkwork.config import Config
from linkwork.functions import similarity as sim
from linkwork.functions import text
from linkwork.functions.phonetics import metaphone
from linkwork.operators import blocking, decision, evaluation, features, tfidf, validate
from linkwork.operators.records import normalize_records
from linkwork.queries import ORACLE, QUERIES, linkage
from linkwork.sources import tables

TABLES = "region nation customer supplier part orders lineitem events documents embeddings labels".split()
CHECKED = ["strip_legal_suffix", "char_ngrams_345", "address_views", "geo_pool", "topk_token", "topk_rare_token", "tfidf_group_cosine", "feat_cross_source", "folds", "threshold_sweep", "matching_long", "validate_idlist"]


def one(spark, *cols):
    return spark.range(1).select(*[c.alias(f"c{i}") for i, c in enumerate(cols)]).first()


def test_name_views(spark):
    norm = lambda s: text.name_views(F.lit(s))["normalized_name"]
    r = one(spark, norm("Shree Balaji Traders & Co"), norm("St. Mary Café"), *[text.remove_legal_suffix(F.lit(s)) for s in ("shree balaji traders co", "acme pvt ltd", "ltd", "corp co")], text.compact(F.lit("street mary cafe")))
    assert list(r) == ["shree balaji traders co", "street mary cafe", "shree balaji traders", "acme", "", "corp", "streetmarycafe"]


def test_ngrams_and_codes(spark):
    r = one(spark, *[text.char_ngrams(F.lit(s), 3) for s in ("ab", "", "a bcd")], text.clean_code(F.lit("94105.0")), text.landmark(F.lit("12 MG Rd, Near SBI ATM")), text.landmark(F.lit("Opp. SBI")), *[text.street_number(F.lit(s)) for s in ("12a main", "12ab main", "main 12")])
    assert [sorted(x) for x in r[:3]] == [["ab"], [], ["abc", "bcd"]]
    assert list(r[3:]) == ["94105", "Near SBI ATM", "Opp. SBI", "12a", None, None]


def test_similarities(spark):
    arr = lambda *x: F.array(*map(F.lit, x)) if x else F.array().cast("array<string>")
    r = one(spark, sim.jaccard(arr("a", "b"), arr("b", "c")), sim.jaccard(arr(), arr("a")), sim.levenshtein_similarity(F.lit("kitten"), F.lit("sitting")), sim.prefix_match(F.lit("94105"), F.lit("94199")), sim.prefix_match(F.lit(None).cast("string"), F.lit("94105")), sim.conflict(F.lit(None).cast("string"), F.lit("x")), sim.conflict(F.lit("x"), F.lit("y")))
    assert [round(x, 6) for x in r] == [0.333333, 0.0, round(1 - 3 / 7, 6), 1.0, 0.0, 0.0, 1.0]
    assert sim.lcs("kitten", "sitting") == 4
    assert round(sim.jaro_winkler_of("martha", "marhta"), 4) == 0.9611
    assert sim.token_set_of(["a", "b"], ["b", "a", "c"]) == 1.0
    assert sim.indel_of("", "") == 1.0


@pytest.mark.parametrize("word,code", [("knight", "NT"), ("thumb", "0M"), ("phone", "FN"), ("school", "SKL"), ("123", "")])
def test_metaphone(word, code):
    assert metaphone(word) == code


def places(spark, rows, name="id"):
    return spark.createDataFrame(rows, f"{name} string, country string, state string, city string")


def test_geo_pool_narrows_and_stops(spark):
    pool = places(spark, [("c1", "us", "tx", "dallas"), ("c2", "us", None, None), ("c3", "in", "mh", "pune")])
    q = places(spark, [("q1", "us", None, "austin"), ("q2", "fr", None, "paris"), ("q3", "us", "tx", "dallas")])
    got = {}
    for r in blocking.geo_pool(*blocking.geo_keys(q, pool)).collect():
        got.setdefault(r.s1, set()).add(r.rid)
    assert got == {"q1": {"c1", "c2"}, "q2": {"c1", "c2", "c3"}, "q3": {"c1"}}


def test_geo_queries_keep_whole_pools(spark):
    """The registered SQL has no cap, so a key with more than 8,000 candidates keeps them all."""
    pool = places(spark, [(f"c{i}", "us", None, None) for i in range(8010)])
    q = places(spark, [("q1", "us", None, None)])
    assert blocking.geo_pool(*linkage.geo(q, pool)).count() == 8010
    assert blocking.geo_pool(*blocking.geo_keys(q, pool)).count() == 8000


def test_rare_token_ties_by_id(spark):
    """Equal weights summed in another order differ in the last bit; such candidates tie."""
    idf = spark.createDataFrame([("x", 0.1), ("y", 0.2), ("z", 0.3), ("u", 0.2), ("v", 0.4)], "token string, idf double")
    words = ["x", "y", "z", "u", "v"]
    q, geo = spark.createDataFrame([("q", words)], "id string, w array<string>"), "id string, geo_key string"
    own = spark.createDataFrame([("c1", ["u", "v"]), ("c2", ["x", "y", "z"])], "id string, w array<string>")
    keys = spark.createDataFrame([("c1", ""), ("c2", "")], geo)
    got = blocking.item_topk(q, own, spark.createDataFrame([("q", "")], geo), keys, "w", 1, "idf", idf).collect()
    assert [(r.rid, round(r.score, 9)) for r in got] == [("c1", 0.6)]


def test_relative_features(spark):
    df = spark.createDataFrame([("a", "1", 0.9), ("a", "2", 0.5), ("a", "3", 0.5), ("b", "1", 0.7)], "s1 string, rid string, s double")
    r = {(x.s1, x.rid): x for x in features.relative_features(df, "s").collect()}
    assert [r["a", str(i)].rank for i in (1, 2, 3)] == [1, 2, 3]
    assert [r["a", str(i)].percentile for i in (1, 2, 3)] == [1.0, 0.5, 0.5]
    assert (r["a", "1"].second_best_score, round(r["a", "1"].score_gap, 6), r["a", "1"].candidate_count) == (0.5, 0.4, 3)
    assert (r["b", "1"].second_best_score, r["b", "1"].score_gap, r["b", "1"].percentile) == (0.0, 0.7, 1.0)


def test_entity_f05_and_rule(spark):
    f = lambda tp, p, t: evaluation.entity_f05(F.lit(tp), F.lit(p), F.lit(t))
    assert [round(x, 6) for x in one(spark, f(2, 3, 2), f(0, 0, 0), f(0, 1, 0), f(0, 0, 1))] == [0.714286, 1.0, 0.0, 0.0]
    df = spark.createDataFrame([(0.8, 0.05, 0.85, 2), (0.8, 0.3, 0.95, 2), (0.4, 0.3, 0.95, 1)], "p double, score_gap double, best_score double, rank int")
    assert [r[0] for r in df.select(decision.hand_rule("p", 0.5)).collect()] == [0, 1, 0]


def test_header_rules():
    assert validate.parse_header("source1_entity_id,matched_entity_ids", ["source1_entity_id", "matched_entity_ids"]) == ["comma separated; tabs are needed"]
    assert validate.parse_header("source1_entity_id\tmatched_entity_ids\n", ["source1_entity_id", "matched_entity_ids"]) == []


def test_tables_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("S1-1", "a", None), ("S1-2", 'b "q"', "c")], "source1_entity_id string, name string, city string")
    for ext in ("tsv", "csv", "parquet"):
        tables.save_table(df, f"{tmp_path}/source1.{ext}")
        assert sorted(map(tuple, tables.load_table(spark, f"{tmp_path}/source1.{ext}").collect())) == sorted(map(tuple, df.collect()))
    assert tables.load_source1(spark, str(tmp_path)).columns[:4] == ["source1_entity_id", "name", "address", "country"]
    with pytest.raises(ValueError):
        tables.load_table(spark, "x.txt")


def test_backends():
    assert isinstance(tfidf.get_backend("tfidf"), tfidf.TfidfBackend)
    with pytest.raises(ValueError):
        tfidf.get_backend("other")
    with pytest.raises(NotImplementedError):
        tfidf.get_backend("external").embed(None)


def test_config(tmp_path):
    p = tmp_path / "c.yaml"
    p.write_text("token_k: 7\ngeo_keys: [country]\n")
    assert (Config.load(str(p)).token_k, Config.load(str(p)).geo_keys) == (7, ("country",))


@pytest.mark.parametrize("name", CHECKED)
def test_queries_match_sql(spark, sf, name):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"create view {t} as select * from read_parquet('{sf}/{t}.parquet')")
    want = con.sql(ORACLE[name])
    cols = sorted(want.columns)
    plain = lambda v: round(float(v), 5) if isinstance(v, float) or type(v).__name__ == "Decimal" else v
    rows = sorted((tuple(plain(r[want.columns.index(c)]) for c in cols) for r in want.fetchall()), key=repr)
    df = QUERIES[name](spark, sf)
    assert sorted(df.columns) == cols
    assert sorted((tuple(plain(r[c]) for c in cols) for r in df.collect()), key=repr) == rows


def test_normalize_records_folds(spark):
    rows = [("S1-1", "Café Ltd", "12 MG Rd, Near SBI ATM", "us", None, "Köln"), ("S1-2", None, "", None, None, None)]
    s1 = tables.coerce(spark.createDataFrame(rows, "source1_entity_id string, name string, address string, country string, state string, city string"), tables.SOURCE1)
    a, b = normalize_records(s1, "source1_entity_id").orderBy("id").collect()
    assert (a.original_name, a.normalized_name, a.name_without_suffix, a.normalized_address, a.landmark, a.street_number, a.city) == ("Café Ltd", "cafe ltd", "cafe", "12 mg road", "Near SBI ATM", "12", "koln")
    assert (b.name_missing, b.address_missing, b.city, b.name_tokens) == (True, True, None, [])


def test_dense_topk_in_blocks(spark, monkeypatch):
    d = spark.createDataFrame([(i, [float(i % 7), float(i % 3), 1.0]) for i in range(40)], "id long, vector array<double>")
    q = d.where("id % 3 = 0")
    whole = sorted(map(tuple, tfidf.dense_topk(q, d, 4).collect()))
    monkeypatch.setattr(tfidf, "QUERY_BLOCK", 5)
    assert len(whole) == 56 and sorted(map(tuple, tfidf.dense_topk(q, d, 4).collect())) == whole


def test_pipeline_links_copies(spark, tmp_path):
    """A small task: each entity's copy with a typo is found, others are not; a stored linker decides alike."""
    from linkwork.plans import pipeline

    words = "alpha bravo carmine delta echo foxglove gamma hollow indigo juniper kestrel lumen maple nectar onyx prism quartz raven sable tundra".split()
    base = [(f"S1-{i}", f"{words[i]} {words[(i * 7 + 3) % 20]} traders", f"{i} {words[(i * 3) % 20]} road", "us", None, f"c{i % 2}") for i in range(20)]
    cols = "name string, address string, country string, state string, city string"
    s1 = tables.coerce(spark.createDataFrame(base, f"source1_entity_id string, {cols}"), tables.SOURCE1)
    twins = [(f"S2-{i}", "S2", b[1].replace("traders", "trader ltd"), b[2].replace("road", "rd"), *b[3:]) for i, b in enumerate(base) if i % 4]
    noise = [(f"S3-{i}", "S3", f"{words[(i * 5 + 1) % 20]} {words[(i * 11 + 6) % 20]} works", f"{i + 40} {words[i]} lane", "us", None, f"c{i % 2}") for i in range(20)]
    s23 = tables.coerce(spark.createDataFrame(twins + noise, f"record_id string, source string, {cols}"), tables.SOURCE23)
    labels = spark.createDataFrame([(f"S1-{r[0][3:]}", "S2", r[0], 1) for r in twins], "source1_entity_id string, candidate_source string, candidate_record_id string, label int")
    linker = pipeline.fit(s1, s23, labels, Config(n_folds=2, entity_model_enabled=False, weight_range=(2.0, 2.0), calibration="platt"), trees=5)
    linker.save(spark, str(tmp_path))
    again = pipeline.Linker.load(spark, str(tmp_path))
    row = pipeline.evaluate(again, s1, s23, labels).first()
    assert row.macro_f05 > 0.8
    assert again.frozen() == linker.frozen() and again.pair.columns == linker.pair.columns
