"""Each stage of the pipeline against brute force on its own input, and the whole run."""

from collections import Counter, defaultdict

import pytest

import corpus_pipeline
from linkwork.llm import quality
from linkwork.llm.common import ALNUM_RE, SPACE_RE, ascii_lower, materialise, table


@pytest.fixture(scope="module")
def steps(spark, sf):
    docs, out = table(spark, sf, "documents"), []
    for name, f in corpus_pipeline.STAGES:
        docs = materialise(f(spark, docs, sf))
        out.append((name, docs))
    return out


def rows(df):
    return [tuple(r) for r in df.select("doc_id", "text", "source").collect()]


def test_stages(spark, sf, steps):
    first = table(spark, sf, "documents")
    assert all(df.columns == first.columns for _, df in steps[:-1])
    quality_, near, clean, mixed, shards = (df for _, df in steps)
    # quality: exactly the documents that the classifier accepts
    model = quality.fit(first, table(spark, sf, "labels"))
    good = {r.doc_id for r in quality.score(first, model).where("predicted = 1").collect()}
    assert {r[0] for r in rows(quality_)} == good
    # near duplicates: one of each component
    own = rows(quality_)
    sets = []
    for _, t, _ in own:
        w = SPACE_RE.findall(ascii_lower(t or ""))
        sets.append({tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set()))
    at = defaultdict(list)
    par = list(range(len(own)))

    def find(x):
        while par[x] != x:
            x = par[x]
        return x

    for i, s in enumerate(sets):
        for j, both in Counter(j for x in s for j in at[x]).items():
            if 100 * both >= 80 * (len(s) + len(sets[j]) - both):
                par[find(i)] = find(j)
        for x in s:
            at[x].append(i)
    least = {}
    for i, r in enumerate(own):
        least[find(i)] = min(least.get(find(i), r[0]), r[0])
    assert sorted(r[0] for r in rows(near)) == sorted(least[i] for i in {find(i) for i in range(len(own))})
    # decontamination: no window is left in what stays, clean documents are unchanged
    windows = set()
    for r in table(spark, sf, "benchmark").collect():
        w = ALNUM_RE.findall(ascii_lower(r.text or ""))
        windows |= {tuple(w[i : i + 10]) for i in range(max(1, len(w) - 9))}
    words = lambda t: ALNUM_RE.findall(ascii_lower(t or ""))
    hit = lambda t: any(tuple(words(t)[i : i + 10]) in windows for i in range(len(words(t)) - 9))
    before, after = {r[0]: r[1] for r in rows(near)}, {r[0]: r[1] for r in rows(clean)}
    assert {d: t for d, t in before.items() if not hit(t)} == {d: t for d, t in after.items() if not hit(before[d])}
    # mixing: whole documents, twice at most, and shards hold them all
    n = Counter(r[0] for r in rows(mixed))
    assert set(n) <= set(after) and max(n.values()) <= 2
    assert Counter(r.doc_id for r in shards.select("doc_id").collect()) == n


def test_run(spark, sf, steps):
    assert corpus_pipeline.run(spark, sf).count() == steps[-1][1].count()
