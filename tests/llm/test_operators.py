"""The corpus operators against brute force, round trips and held-out labels, with odd rows in every table."""

import hashlib
import random
import re
import struct
import uuid
import zlib
from collections import Counter, defaultdict
from math import log10

import duckdb
import numpy as np
import pyarrow as pa
import pytest
import xxhash
from pyspark.sql import functions as F

from linkwork.llm import decontam, html_extract, imatch, lm_score, mix, ngram_join, quality, shard, token_count, toxicity
from linkwork.llm.common import ALNUM_RE, SPACE_RE, ascii_lower, word_counts

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, n_items long, node long"


def texts(n, seed=3):
    r = random.Random(seed)
    words = ["".join(r.choice("abcdefgh") for _ in range(r.randint(1, 6))) for _ in range(300)]
    return [" ".join(r.choice(words) + r.choice(["", "", "", ",", "."]) for _ in range(r.randint(1, 60))) for _ in range(n)]


def rows(n=60):
    """Ordinary texts, copies, near copies, null, empty and blank ones, repeated rows, a long one, and clashing columns."""
    own = texts(n)
    own += [own[0], own[0], own[1] + " tail", own[2].upper(), None, "", "  \n ", "é ü 日本 \x00x", "one", "one", " ".join(own) * 3]
    out = [(i, t, "en", [None, "a", "b", "c"][i % 4], len(t or ""), 1, 2) for i, t in enumerate(own)]
    return [*out, out[3], out[3], (None, "null id text here", None, None, None, None, None)]


@pytest.fixture(scope="module")
def docs(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(3).persist()


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], SCHEMA)


def shingles(t, k):
    w = SPACE_RE.findall(ascii_lower(t or ""))
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def test_word_counts():
    t = [r[1] for r in rows()]
    assert word_counts(pa.array(t, pa.string())).tolist() == [len(SPACE_RE.findall(x or "")) for x in t]


# 4
def test_decontamination_brute_force(spark, docs, none):
    own = rows()
    items = [("i1", " ".join(own[5][1].split()[:25])), ("i2", "one"), ("i3", None), ("i4", ""), (None, own[7][1]), ("i1", own[9][1])]
    bench = spark.createDataFrame(items, "item_id string, text string")
    for limit in (10_000, 5):  # one automaton, and several
        got = Counter(map(tuple, decontam.contamination(docs, bench, 10, max_words=limit).select("doc_id", "n_words", "n_hit", "n_items", "items_sha256", "contaminated").collect()))
        windows = defaultdict(set)
        for name, t in items:
            w = ALNUM_RE.findall(ascii_lower(t or ""))
            for i in range(max(1, len(w) - 9) if w else 0):
                windows[tuple(w[i : i + 10])].add("null" if name is None else name)
        want = Counter()
        for d, t, *_ in own:
            w = ALNUM_RE.findall(ascii_lower(t or ""))
            hit, found = [0] * len(w), set()
            for k in {len(x) for x in windows}:
                for i in range(len(w) - k + 1):
                    if names := windows.get(tuple(w[i : i + k])):
                        found |= names
                        hit[i : i + k] = [1] * k
            want[d, len(w), sum(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), sum(hit) > 0] += 1
        assert got == want
    assert decontam.contamination(none, bench, 10).count() == 0
    assert decontam.contamination(docs, bench.limit(0), 10).where("contaminated").count() == 0


def test_decontaminate_cuts_spans(spark):
    passage = " ".join(f"w{i}" for i in range(12))
    d = spark.createDataFrame([(1, f"before it {passage.upper()} after that and more words to keep the coverage low", 0), (2, passage, 0), (3, "clean", 5), (4, None, None)], "doc_id long, text string, n_chars long")
    b = spark.createDataFrame([("x", passage)], "item_id string, text string")
    got = {r.doc_id: (r.text, r.n_chars) for r in decontam.decontaminate(d, b).collect()}
    text = "before it  after that and more words to keep the coverage low"
    assert got == {1: (text, len(text)), 3: ("clean", 5), 4: (None, None)}


# 9
def test_token_counts_match_the_library(spark, docs, none):
    import public_tokenizers
    import sentencepiece

    path = public_tokenizers.path("piece_bpe_32k.model")
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    t = token_count.load(path)
    r = random.Random(5)
    alphabet = [chr(i) for i in range(32, 127)] + list(" \n\t▁éñß中文😀    \x00") + ["<0x0A>", "</s>", "the ", "ing"]
    odd = ["".join(r.choice(alphabet) for _ in range(r.randint(0, 50))) for _ in range(300)]
    want = [len(x) for x in sp.encode(odd)]
    assert token_count.batch_counts(pa.array(odd), t).tolist() == want
    assert [token_count.scan_chunks(x, t, 7) for x in odd] == want
    got = Counter((x.doc_id, x.n_tokens, x.n_bytes) for x in token_count.token_counts(docs, path, chunk=200).collect())
    assert got == Counter((d, len(sp.encode(x or "")), len((x or "").encode())) for d, x, *_ in rows())
    assert token_count.token_counts(none, path).count() == 0


# 5
def test_mix_matches_sql(spark, docs, none):
    con = duckdb.connect()
    con.register("documents", pa.table({"doc_id": [r[0] for r in rows()], "text": [r[1] for r in rows()], "source": [r[3] for r in rows()]}))
    want = Counter(con.sql(mix.ORACLE_SQL).select("doc_id, size, source_size, target, taken").fetchall())
    got = mix.mix(docs).collect()
    assert Counter(tuple(r) for r in got) == want
    assert all(r.taken <= 2 * r["size"] for r in got)
    words = sum(len(SPACE_RE.findall(r.text or "")) for r in mix.mixed(docs).collect())
    assert words == sum(r.taken for r in got)
    assert mix.mix(none).count() == 0


# 3
def test_shards(spark, docs, none):
    got = shard.shard(docs, 4).collect()
    assert Counter(r.doc_id for r in got) == Counter(r[0] for r in rows())
    text = {r[0]: r[1] or "" for r in rows()}
    assert all(r["size"] == len(text[r.doc_id].encode()) + 1 and r.text_crc32 == zlib.crc32(text[r.doc_id].encode()) for r in got)
    slots = defaultdict(list)
    for r in got:
        slots[r.shard].append(r.slot)
    assert all(sorted(x) == list(range(len(x))) for x in slots.values()) and set(slots) <= set(range(4))
    assert shard.shard(none, 4).count() == 0


def test_shards_are_even_and_keep_groups(spark):
    d = spark.createDataFrame([(i, f"text {i % 700 if i % 3 else 7} " + "x" * (i * 37 % 200)) for i in range(3000)], "doc_id long, text string")
    got = shard.shard(d, 8).toPandas()
    size = got.groupby("shard")["size"].sum()
    assert size.max() / size.mean() < 1.02 and size.min() / size.mean() > 0.98


# 2
def test_fingerprints(spark, docs, none):
    own = sorted(rows(), key=lambda r: (r[0] is None, -(r[0] or 0)))
    got = imatch.fingerprints(docs, ranges=5).collect()
    assert len(got) == len(own)
    text = [r[1] or "" for r in own]
    want = Counter()
    for i, t in enumerate(text):
        nxt = text[(i + 1) % len(text)]
        k = len(t) // 3
        want[own[i][0], len(t), hashlib.sha256((t[: len(t) - k] + nxt[:k]).encode()).hexdigest()] += 1
    assert Counter((r.doc_id, r.n_chars, r.edited_sha256) for r in got) == want
    prints = defaultdict(set)
    for r in got:
        prints[{x[0]: x[1] or "" for x in own}[r.doc_id]].add(r.fingerprint)
    assert all(len(x) == 1 for x in prints.values())
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert imatch.fingerprints(none).count() == 0


def test_fingerprints_of_text_ids(spark):
    """Ids that are text follow in the order of their text, over several ranges."""
    own = [(f"x{chr(97 + i % 26)}{i:03d}", t) for i, t in enumerate(texts(60, 5))] + [(None, "no id"), ("é", "other")]
    got = imatch.fingerprints(spark.createDataFrame(own, "doc_id string, text string").repartition(3), ranges=4).collect()
    order = sorted(own, key=lambda r: (r[0] is not None, (r[0] or "").encode()), reverse=True)
    want = set()
    for i, (d, t) in enumerate(order):
        k = len(t) // 3
        want.add((d, hashlib.sha256((t[: len(t) - k] + order[(i + 1) % len(order)][1][:k]).encode()).hexdigest()))
    assert {(r.doc_id, r.edited_sha256) for r in got} == want and len(got) == len(own)


def test_lexicon_counts_terms_exactly(spark, docs, monkeypatch):
    """Terms of one document each stay outside the band, however many; a shuffled lexicon gives the same prints."""
    d = spark.createDataFrame([(i, " ".join(f"t{i}x{j}" for j in range(1000))) for i in range(40)], "id long, text string")
    assert imatch.frequencies(d.selectExpr("text", "id AS ref")).agg(F.max("n"), F.count("*"), F.count("ref")).first() == (1, 40_000, 40_000)
    got = []
    for bound in (1 << 20, 0):
        monkeypatch.setattr(imatch, "BROADCAST", bound)
        got.append(Counter(map(tuple, imatch.fingerprints(docs, ranges=5).collect())))
    assert got[0] == got[1]


def test_fingerprints_match_brute_force(spark):
    """Fingerprints and likenesses by the definition: exact frequencies, subsets by hash, words cut at the seams included."""
    xx = lambda b, seed=42: xxhash.xxh64_intdigest(b, seed=seed)
    r = random.Random(4)
    common, some = [f"w{i}" for i in range(30)], [f"m{i:04d}" for i in range(1000)] + [f"m{i:03d}" for i in range(100)]
    own = [" ".join([*r.choices(common, k=20), *r.choices(some, k=r.randint(5, 90)), *(f"u{i}x{j}" for j in range(r.randint(0, 9)))]) for i in range(80)]
    own = [" ".join(r.sample(t.split(), len(t.split()))) for t in own] + [own[0], own[1], "", "x"]
    terms = lambda t: set(re.findall(r"[0-9a-z]+", t))
    df = Counter(w for t in own for w in terms(t))
    band = {w for w, c in df.items() if 2 <= c <= max(2, 0.05 * len(own))}

    def prints(t):
        every = terms(t)
        level, out = max(len(every), 1).bit_length() - 1, {}
        for w in every if len(every) <= 32 else every & band:
            h = xx(w.encode())
            sub = lambda k, h=h: xx(struct.pack("<i", k), xx(struct.pack("<Q", h)))
            for k in range(imatch.SUBSETS):
                for i in (0, 1):
                    if sub(k) & ((1 << (level + i)) - 1) == 0:
                        out[level + i, k] = out.get((level + i, k), 0) ^ sub(k + 1000)
        return {s: f"{x & 0xFFFFFFFF:08x}" for s, x in out.items()}

    def near(a, b):
        if not a and not b:
            return 1.0
        levels = {s[0] for s in a} & {s[0] for s in b}
        slots = {s for s in a | b if s[0] in levels}
        return sum(a.get(s) == b.get(s) for s in slots) / len(slots) if slots else 0.0

    text = lambda p: ",".join(f"{lv}.{k}.{p[lv, k]}" for lv, k in sorted(p, key=lambda s: (s[1], s[0]))) or "0"
    got = {x.doc_id: x for x in imatch.fingerprints(spark.createDataFrame(list(enumerate(own)), "doc_id long, text string").repartition(3), ranges=4).collect()}
    seams = 0
    for i, t in enumerate(own):
        nxt = own[i - 1]
        new = t[: len(t) - len(t) // 3] + nxt[: len(t) // 3]
        seams += len((terms(new) - terms(t) - terms(nxt)) & band) if len(terms(new)) > 32 else 0
        a, b, c = prints(t), prints(new), prints(nxt)
        assert (got[i].fingerprint, got[i].edited_fingerprint) == (text(a), text(b))
        assert abs(got[i].near_edited - near(a, b)) < 1e-9 and abs(got[i].near_next - near(a, c)) < 1e-9
    assert seams


# 6
def test_join_matches_brute_force(spark, none):
    r = random.Random(8)
    base = texts(25, 9)
    own = list(base)
    for t in base[:15]:
        for _ in range(4):
            w = t.split()
            for _ in range(r.randint(0, 3)):
                w[r.randrange(len(w))] = "zz"
            own.append(" ".join(w))
    data = [(i, t, None, None, None, None, None) for i, t in enumerate(own)] + rows()[-12:]
    d = spark.createDataFrame(data, SCHEMA).repartition(3)
    for width, percent in ((4, 85), (5, 80)):
        sets = [shingles(x[1], width) for x in data]
        par = list(range(len(data)))

        def find(x):
            while par[x] != x:
                x = par[x]
            return x

        for i, a in enumerate(sets):
            for j in range(i):
                both = len(a & sets[j])
                if both and 100 * both >= percent * (len(a) + len(sets[j]) - both):
                    par[find(i)] = find(j)
        group = defaultdict(list)
        for i in range(len(data)):
            group[find(i)].append(data[i][0])
        want = Counter()
        for i, x in enumerate(data):
            ids = [v for v in group[find(i)] if v is not None]
            want[x[0], len(sets[i]), min(ids) if ids else None] += 1
        got = Counter((x.doc_id, x.n_shingles, x.component_id) for x in ngram_join.join(d, width, percent).collect())
        assert got == want
    kept = ngram_join.keep_one(d, 5, 80).collect()
    empty = sum(not s for s in sets)
    assert len(kept) == len({find(i) for i in range(len(data)) if sets[i]}) + empty
    assert ngram_join.join(none).count() == 0 and ngram_join.keep_one(none).count() == 0


def test_long_bucket_keeps_its_nodes(spark):
    """A bucket of many batches loses no node and has one leader; nodes that stand alone go."""
    ngram_join.prepare(spark)
    sig = spark.range(70_001).selectExpr("array(7L, 100 + id, id % 2) AS buckets", "id AS node").repartition(5)
    got = ngram_join.met_nodes(sig.unionByName(sig.where("node < 9"))).where("sh = 7").toPandas()
    assert len(got) == got["node"].nunique() == 70_001 and set(got["lead"]) == {0}
    assert ngram_join.met_nodes(sig).where("sh >= 100").count() == 0


def test_linked_sets_share_a_bucket():
    """Every pair that links has a bucket in common, at all sizes and thresholds, by groups and by least hashes."""
    rng = np.random.default_rng(4)
    for percent in (60, 80, 85, 95):
        for n in [*range(1, 60), 150, 700]:
            for _ in range(6):
                a = rng.integers(0, 1 << 63, n).astype(np.uint64)
                cut = int(rng.integers(0, n // 3 + 1))
                b = np.concatenate([a[cut:], rng.integers(0, 1 << 63, int(rng.integers(0, n // 3 + 1))).astype(np.uint64)])
                a, b = np.unique(a), np.unique(b)
                both = len(np.intersect1d(a, b))
                if both < max(len(a), len(b)) and 100 * both >= percent * (len(a) + len(b) - both):
                    assert len(np.intersect1d(ngram_join.bucket_hashes(a, percent), ngram_join.bucket_hashes(b, percent)))


def test_join_of_large_groups(spark, monkeypatch):
    """Chains and stars of near copies in split buckets: components as by brute force, few pairs."""
    r = random.Random(3)
    base = ["".join(r.choice("abcdefgh") for _ in range(5)) for _ in range(60)]
    own = []
    for i in range(400):
        w = list(base)
        for k in range(i % 40):  # a chain: neighbours are alike, the ends are not
            w[k] = f"z{k}"
        w[50 + i % 7] += "x" * (i % 3)
        own.append(" ".join(w))
    sets = [shingles(t, 4) for t in own]
    par = list(range(len(own)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(a & sets[j])
            if 100 * both >= 85 * (len(a) + len(sets[j]) - both):
                x, y = sorted((find(i), find(j)))
                par[y] = x
    monkeypatch.setattr(ngram_join, "PART", 16)
    d = spark.createDataFrame(list(enumerate(own)), "doc_id long, text string").repartition(4)
    for rounds in (1, 3):
        monkeypatch.setattr(ngram_join, "ROUNDS", rounds)
        got = {x.doc_id: x.component_id for x in ngram_join.join(d).collect()}
        assert got == {i: find(i) for i in range(len(own))}


def test_rtree_bounds_lose_no_pair():
    rng = np.random.default_rng(1)
    sets = [rng.choice(400, 40, replace=False) for _ in range(80)]
    sets += [np.concatenate([s[:-1], [500 + i]]) for i, s in enumerate(sets[:40])]
    vec = np.stack([np.bincount(s % 64, minlength=64) for s in sets]).astype(np.uint8)
    n, cls = np.full(len(sets), 40), np.arange(1, len(sets) + 1)
    p, q = ngram_join.RTree(vec, n, cls).pairs(85)
    found = {tuple(sorted(x)) for x in zip(p.tolist(), q.tolist(), strict=True)}
    real = {(i, j) for i in range(len(sets)) for j in range(i + 1, len(sets)) if len(set(sets[i]) & set(sets[j])) * 185 >= 85 * 80}
    assert real and real <= found


# 7
def test_extraction(spark):
    page = "<html><body><nav><ul><li><a href=/>Home</a></li><li><a href=/b>Other</a></li></ul></nav><article><h1>A title</h1><p>First &amp; best\n  paragraph, with <b>bold</b> words and more of them.<p>Second one, not closed.</article><section class=comments><h3>2 comments</h3><p>I disagree.</p></section><footer>&copy; site</footer></body></html>"
    d = spark.createDataFrame([(1, "u", page, "x"), (2, None, None, "x"), (3, "u", "", "x"), (4, "u", page[:-200], "x"), (5, "u", "<p", "x")], "page_id long, url string, html string, text string")
    got = {r.page_id: (r.text, r.n_chars) for r in html_extract.extract(d).collect()}
    want = "A title\nFirst & best paragraph, with bold words and more of them.\nSecond one, not closed."
    assert got[1] == (want, len(want))
    assert got[2] == got[3] == got[5] == ("", 0)
    assert html_extract.extract(d.limit(0)).count() == 0


def test_extraction_outside_blocks():
    """A page without block elements is one block; markup, menus and references as elsewhere."""
    text = "Just plain article text that goes on for a while, with a comma &amp; more, until it has said what it had to say. " * 4
    got = html_extract.extract_texts(["\n ".join([text[:50] + "<b>" + text[50:60] + "</b>" + text[60:], "<nav><ul><li><a href=/>Home</a></li><li><a href=/b>Other</a></li></ul></nav>"])], html_extract.model())
    assert got == [" ".join(text.replace("&amp;", "&").split())]


def test_extraction_held_out():
    made = html_extract.synthetic_pages(150, 77)
    x, parent, begin = html_extract.features(made)
    y = html_extract._labels(made, parent, begin)
    kept = html_extract.decode(html_extract.model().odds(x), parent, x[:, 0].astype(int), np.sqrt(np.expm1(x[:, 1])) + 0.5)
    there = x[:, 1] > 0
    assert (kept == (y > 0))[there].mean() > 0.98
    assert all(kept[parent[v]] for v in np.flatnonzero(kept & (parent >= 0)))


# 8
def test_nearest_is_exact():
    rng = np.random.default_rng(2)
    mat = rng.random((300, 40)) * (rng.random((300, 40)) < 0.1)
    mat = mat[mat.any(1)]
    mat = (mat / np.sqrt((mat**2).sum(1, keepdims=True))).astype(np.float32)
    index = toxicity.BlockMaxIndex(mat, np.ones(len(mat)), np.ones(len(mat)), list(range(len(mat))))
    for _ in range(50):
        q = rng.random(40).astype(np.float32) * (rng.random(40) < 0.1)
        t = np.flatnonzero(q)
        _, got = index.nearest(t, q[t], 7)
        s = np.sort(mat @ q)[::-1][:7]
        assert np.allclose(got, s[s > 1e-9], atol=1e-5)
    # ties go to the earlier example, and several queries at once find what each finds alone
    tied = np.zeros((160, 40), np.float32)
    tied[:, 0] = 1
    tied[32::2] = np.eye(40, dtype=np.float32)[1]
    index = toxicity.BlockMaxIndex(tied, np.ones(160), np.ones(160), list(range(160)))
    q = np.array([0, 1]), np.array([0.5, 0.5], np.float32)
    assert index.nearest(*q, 7)[0].tolist() == list(range(7))
    many = index.search([q[0], np.array([1]), np.array([5])], [q[1], np.ones(1, np.float32), np.ones(1, np.float32)], 7)
    assert [x[0].tolist() for x in many] == [list(range(7)), list(range(32, 46, 2)), []]


def marked(spark, n=400):
    r = random.Random(4)
    data, marks = [], []
    for i, t in enumerate(texts(n, 12)):
        bad = r.random() < 0.4
        data.append((i, t + " vileword awfulone" if bad else t, None, None, None, None, None))
        marks.append((i, int(not bad), int(bad)))
    more = [(n, None, None, None, None, None, None), (n + 1, "", None, None, None, None, None), (None, "x", None, None, None, None, None)]
    return spark.createDataFrame(data + more, SCHEMA), spark.createDataFrame([*marks, (5, None, None), (None, 1, 1)], "doc_id long, quality int, toxic int"), {i: b for i, _, b in marks}


def test_classifiers_held_out(spark, none):
    d, labels, bad = marked(spark)
    model, vecs = toxicity.fit(d, labels)
    tox = [r for r in toxicity.score(vecs, model).collect() if r.held_out and r.doc_id in bad]
    assert np.mean([r.predicted == bad[r.doc_id] for r in tox]) > 0.95
    q = quality.fit(d, labels, epochs=15)
    good = [r for r in quality.score(d, q).collect() if r.held_out and r.doc_id in bad]
    assert np.mean([r.predicted == 1 - bad[r.doc_id] for r in good]) > 0.9
    assert quality.keep_good(d, q).columns == d.columns
    empty, vecs = toxicity.fit(d, labels.limit(0))
    assert {r.score for r in toxicity.score(vecs, empty).collect()} == {0}
    assert {r.score for r in quality.score(d, quality.fit(d, labels.limit(0))).collect()} == {0.5}
    assert quality.score(none, q).count() == 0


def test_toxicity_searches_all_terms(spark):
    """A near copy of a toxic example in words that no other text has is found; norms and frequencies are exact, joined or not."""
    own = texts(60, 21)
    held = [i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 5 == 0]
    free = [i for i in range(1000, 2000) if zlib.crc32(str(i).encode()) % 5]
    rare = " ".join(f"qz{chr(97 + i)}odd{i}" for i in range(30))
    data = [(free[i], t) for i, t in enumerate(own)] + [(free[60], rare), (held[0], rare + " another"), (held[1], "neverseen wordsonly")]
    d = spark.createDataFrame(data, "doc_id long, text string").repartition(3)
    labels = spark.createDataFrame([(free[i], int(i == 60)) for i in range(61)], "doc_id long, toxic int")
    got = []
    for known in (1 << 20, 50):
        model, vecs = toxicity.fit(d, labels, known=known)
        assert model.totals is None or known == 50
        got.append({r.doc_id: (round(r.score, 6), r.predicted, list(r.evidence)) for r in toxicity.score(vecs, model).collect()})
    assert got[0] == got[1]
    assert got[0][held[0]][1:] == (1, [str(free[60])])
    assert got[0][held[1]] == (round(1 / 61, 6), 0, [])
    # evidence against brute force over all terms
    bag = {i: Counter(x for w in SPACE_RE.findall(ascii_lower(t)) for x in [(0, w)] + [(k, w[:k]) for k in (4, 5, 6) if len(w) >= k]) for i, t in data}
    df = Counter(x for b in bag.values() for x in b)
    vec = {i: {x: (1 + np.log(n)) * (np.log((1 + len(data)) / (1 + df[x])) + 1) for x, n in b.items()} for i, b in bag.items()}
    dot = lambda a, b: sum(v * b.get(x, 0) for x, v in a.items())
    for i in vec:
        near = sorted(((dot(vec[i], vec[free[j]]) / np.sqrt(dot(vec[free[j]], vec[free[j]])), free[j]) for j in range(61)), reverse=True)
        assert not near[0][0] or got[0][i][2][0] == str(near[0][1])


# 1
def test_lm_scores(spark, docs, none):
    got = lm_score.score(docs).collect()
    own = [(r[0], r[1]) for r in rows()]
    text_of = lambda t: [*SPACE_RE.findall(ascii_lower(t or "")), None]
    held = lambda d: zlib.crc32(("" if d is None else str(d)).encode()) % 10 == 0
    c = Counter(w for d, t in own if not held(d) for w in text_of(t))
    n, v = sum(c.values()), len(c)
    want = Counter()
    for d, t in own:
        w = text_of(t)
        want[d, held(d), len(w), sum(c[x] > 0 for x in w), n, round(sum(log10((c[x] + 0.1) / (n + 0.1 * (v + 1))) for x in w), 5)] += 1
    assert Counter((r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, round(r.base_score, 5)) for r in got) == want
    assert all(r.score < 0 for r in got)
    assert lm_score.score(none).count() == 0


def test_lm_scores_do_not_depend_on_partitions(spark, docs, monkeypatch):
    """With rare words to spell, however many tasks read the table."""
    monkeypatch.setattr(lm_score, "VOCAB", 40)
    got = [Counter((r.doc_id, round(r.score, 3)) for r in lm_score.score(docs.repartition(n, "text")).collect()) for n in (1, 6)]
    assert got[0] == got[1]


def test_lm_weights_take_all_training_texts(spark, tmp_path, monkeypatch):
    """Every text takes part once in the sums of the first weights, however many tasks there are, which do not change the weights."""
    own = lm_score.word_sums

    def noted(batch, *rest):
        (tmp_path / uuid.uuid4().hex).write_text(str(len(batch.off) - 1))
        return own(batch, *rest)

    d = spark.createDataFrame([(i, f"w{i % 7} a{i} b{i % 3}") for i in range(700)], "id long, text string")
    monkeypatch.setattr(lm_score, "word_sums", noted)
    got = []
    for n in (1, 7):
        totals = lm_score.word_totals(d)
        got.append(lm_score.fit(d.repartition(n, "text"), totals, 2800))
        assert sum(int(x.read_text()) for x in tmp_path.iterdir()) == 700 * len(got)
    assert np.allclose(got[0].words, got[1].words, atol=1e-5) and np.allclose(got[0].letters, got[1].letters, atol=1e-5)
    assert not np.allclose(got[0].words, lm_score.first_weights())


def test_lm_newton_step_matches_brute_force():
    r = np.random.default_rng(5)
    x, gate, bit = r.normal(size=(5, 400)).astype(np.float32), r.integers(0, 3, 400) * 7, r.integers(0, 2, 400)
    total = np.zeros((lm_score.GATES, 5, 6))
    for part in (slice(0, 150), slice(150, 400)):
        lm_score.newton_sums(total, x[:, part], gate[part], bit[part])
    want = np.full((lm_score.GATES, 5), 0.3)
    for g in set(gate.tolist()):
        grad, curve = np.zeros(5), 10 * np.eye(5)
        for i in np.flatnonzero(gate == g):
            p = 1 / (1 + np.exp(-0.3 * float(x[:, i].sum())))
            grad += (bit[i] - p) * x[:, i]
            curve += p * (1 - p) * np.outer(x[:, i], x[:, i])
        want[g] += np.linalg.inv(curve) @ grad
    assert np.allclose(lm_score.newton(total).T, want, atol=1e-4)


def test_lm_scores_do_not_depend_on_neighbours(spark):
    """A text costs the same alone and among texts whose blocks are more than one part holds; counts match a plain loop."""
    own = [" ".join(f"w{(i * k) % 37}" for k in range(1, 100 + i % 3)) for i in range(300)]
    d = spark.createDataFrame(list(enumerate(own)), "id long, text string")
    totals = lm_score.word_totals(d)
    n = totals.agg(F.sum("c")).first()[0]
    model = lm_score.fit(d, totals, n)
    together = model.costs(lm_score.Batch(pa.array(own), model.code))
    alone = [model.costs(lm_score.Batch(pa.array([t]), model.code))[0] for t in own]
    assert np.allclose(together, alone, rtol=1e-6)
    tables = lm_score.Tables(lm_score.table_bits(n), np.zeros(2 * sum(1 << b for b in lm_score.table_bits(n)), np.int32))
    batch = lm_score.Batch(pa.array(own), model.code)
    lm_score.count_words(batch, model.code, tables)
    want, mixer = np.zeros_like(tables.counts), lm_score.Mixer(tables, False)
    bits = model.code.words.expand(batch.ids)
    for s in mixer.slots(batch.contexts, bits):
        for at, b in zip(s.tolist(), bits.bit.tolist(), strict=True):
            want[2 * at + b] += 1
    assert (tables.counts == want).all()


def test_lm_steps_give_each_node_of_a_context_one_slot():
    """Places in a step's subtree are those of a walk down the code, so a node always meets the same slot in a context."""
    tree = lm_score.Tree(np.arange(1, 400))
    for a, n in zip(tree.start.tolist(), tree.length.tolist(), strict=True):
        for d in range(n):
            at = 1
            for b in tree.bit[a + d // 4 * 4 : a + d].tolist():
                at = 2 * at + b
            assert tree.sub[a + d] == at
    bits = tree.expand(np.arange(399))
    mixer = lm_score.Mixer(lm_score.Tables(lm_score.table_bits(0), None), False)
    slots, node = mixer.slots_of(1, np.full(399, 7, np.uint32), bits), tree.node[bits.at]
    assert len(set(zip(node.tolist(), slots.tolist(), strict=True))) == len(set(node.tolist())) == 398


def test_lm_tables_grow_with_the_training_tokens():
    assert [lm_score.table_bits(10**k)[1] for k in (0, 6, 7, 8, 12)] == [20, 20, 21, 22, 22]


def test_lm_code_is_a_distribution():
    """Code lengths of both trees satisfy Kraft's equality, so the mixed bits sum to one."""
    for counts in (np.array([5, 3, 2, 1, 1]), np.arange(1, 50)):
        assert abs(sum(2.0 ** -int(x) for x in lm_score.Tree(counts).length) - 1) < 1e-12


def test_no_swallowed_imports():
    source = open(re.sub(r"tests.*", "corpus_pipeline.py", __file__)).read()
    assert "except" not in source


def test_join_takes_few_pairs_of_a_group_of_which_few_are_alike(spark, monkeypatch):
    r = random.Random(11)
    base = [f"w{i}" for i in range(150)]
    rows = []
    for i in range(160):  # some 3 words changed in each: few pairs are alike
        own = [f"x{i}y{k}" if r.random() < 0.02 else w for k, w in enumerate(base)]
        rows.append((i, " ".join(own)))
    sets = [{tuple(t.split()[k : k + 4]) for k in range(147)} for _, t in rows]
    root = list(range(160))
    alike = [(a, b) for a in range(160) for b in range(a) if 100 * len(sets[a] & sets[b]) >= 85 * len(sets[a] | sets[b])]
    for _ in root:
        for a, b in alike:
            root[a] = root[b] = min(root[a], root[b])
    assert 500 < len(alike) < 160 * 159 // 4
    taken, rest = [], ngram_join.rest_pairs
    monkeypatch.setattr(ngram_join, "rest_pairs", lambda *a: taken.append(rest(*a)) or taken[-1])
    got = {x.doc_id: x.component_id for x in ngram_join.join(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert got == dict(enumerate(root))
    assert sum(t.count() for t in taken) < len(alike)


def test_lean_tasks_give_memory_back(monkeypatch):
    from linkwork.llm import common

    gone = []
    monkeypatch.setattr(common, "release", lambda: gone.append(1))
    assert list(common.lean(lambda batches: (b + 1 for b in batches))([1, 2])) == [2, 3] and gone == [1]
    half = common.lean(lambda batches: iter(batches))([1, 2])
    next(half)
    half.close()
    assert gone == [1, 1]


def full_collections(spark) -> int:
    beans = spark._jvm.java.lang.management.ManagementFactory.getGarbageCollectorMXBeans()
    return sum(b.getCollectionCount() for b in beans if "Old" in b.getName() or "MarkSweep" in b.getName())


def test_toxicity_fit_gives_the_drivers_memory_back(spark):
    """Before and after the index is made, the driver's JVM and Python give back what they have freed."""
    docs = spark.createDataFrame([(i, f"word{i % 7} common text{i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, toxic int")
    before = full_collections(spark)
    toxicity.fit(docs, labels)
    assert full_collections(spark) - before >= 4


def test_quality_fit_gives_the_drivers_memory_back(spark):
    docs = spark.createDataFrame([(i, f"word{i % 7} common text{i}") for i in range(40)], "doc_id long, text string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)], "doc_id long, quality int")
    before = full_collections(spark)
    quality.fit(docs, labels)
    assert full_collections(spark) - before >= 2


def test_lm_inputs_of_words_without_slots_of_the_first_predictor(spark):
    """op1_lm_scoring: logits of the code's places and looked-up halves are those of the slots, bit by bit."""
    words = [f"w{i}" for i in range(40)]
    hashes = lm_score.word_hashes(pa.array(words)).view(np.int64)
    order = np.argsort(hashes)
    code = lm_score.Code(hashes[order], order, lm_score.Tree(np.arange(1, 43)), lm_score.Tree(np.ones(257)), 40, 41)
    rng = np.random.default_rng(2)
    bits = lm_score.table_bits(0)
    counted = lm_score.Tables(bits, rng.integers(0, 9, 2 * sum(1 << b for b in bits)).astype(np.int32))
    batch = lm_score.Batch(pa.array([" ".join(rng.choice(words, 30)) for _ in range(5)]), code)
    seen = code.words.expand(batch.ids)
    level = seen.tree.level[seen.at]
    for tables, out in ((counted.frozen(), None), (counted.left_out(), seen.bit)):
        mixer = lm_score.Mixer(tables, False)
        slots = mixer.slots(batch.contexts, seen)
        x, gate = mixer.word_inputs(batch.contexts, seen, out)
        assert (gate == tables.sure[slots[1]] * 4 + level).all()
        for k, s in enumerate(slots):
            assert (x[k] == tables.logit[s if out is None else 2 * s + out].astype(np.float32)).all()
