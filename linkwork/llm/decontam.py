"""Benchmark decontamination by a generalised suffix automaton of the items' words.

The items (a bounded table) become one automaton over word numbers. A document
is streamed through it: the automaton's state and the length of the longest
matching run of words tell which windows end at each word. Only runs of words
that all occur in items are streamed, since no match crosses another word.

Items beyond ``max_words`` words are dealt to several automata, whose hits are
united per document. Defined results: null or empty texts have no words and no
hits; items without words are ignored; repeated items count by their id; a null
item_id reads "null"; no items means no hits; other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import ALNUM_RE, alnum_words, ascii_lower, lean, parts, prepare, texts

#: Words of the items that one automaton may hold (some hundred bytes each).
MAX_WORDS = 1_000_000
#: Bytes of text that are split into words at once.
SLICE = 2 << 20


class SuffixAutomaton:
    """Generalised suffix automaton of word-number sequences, with the items of each state."""

    def __init__(self, items: list[tuple[str, list[str]]], window: int):
        self.window = window
        self.vocab: dict[str, int] = {}
        self.step: list[dict[int, int]] = [{}]
        self.link, self.length = [-1], [0]
        ends: dict[int, set[str]] = defaultdict(set)
        shorts: dict[int, dict[int, set[str]]] = defaultdict(lambda: defaultdict(set))
        for name, words in items:
            last = 0
            for w in words:
                last = self._extend(last, self.vocab.setdefault(w, len(self.vocab)))
        for name, words in items:
            v = 0
            for k, w in enumerate(words):
                v = self.step[v][self.vocab[w]]
                # the state of a prefix may stand for longer strings too; suffixes of it are reached by links
                if k + 1 >= window:
                    ends[v].add(name)
            if 0 < len(words) < window:
                shorts[v][len(words)].add(name)
        order = sorted(range(len(self.link)), key=self.length.__getitem__, reverse=True)
        for v in order:
            if v in ends and self.link[v] > 0 and self.length[self.link[v]] >= window:
                ends[self.link[v]] |= ends[v]
        self.items = dict(ends)
        self.short = {v: sorted((k, tuple(sorted(x))) for k, x in by.items()) for v, by in shorts.items()}
        self.up = [-1] * len(self.link)  # the nearest state on the path of links, itself included, that has a short item
        for v in reversed(order):
            self.up[v] = v if v in self.short else (self.up[self.link[v]] if self.link[v] >= 0 else -1)
        self.least = min([min(len(w), window) for _, w in items if w], default=0)

    def _extend(self, last: int, c: int) -> int:
        step, link, length = self.step, self.link, self.length
        if c in step[last]:
            q = step[last][c]
            if length[q] == length[last] + 1:
                return q
            return self._clone(last, c, q)
        cur = len(link)
        step.append({})
        link.append(0)
        length.append(length[last] + 1)
        p = last
        while p >= 0 and c not in step[p]:
            step[p][c] = cur
            p = link[p]
        if p >= 0:
            q = step[p][c]
            link[cur] = q if length[q] == length[p] + 1 else self._clone(p, c, q)
        return cur

    def _clone(self, p: int, c: int, q: int) -> int:
        step, link, length = self.step, self.link, self.length
        new = len(link)
        step.append(dict(step[q]))
        link.append(link[q])
        length.append(length[p] + 1)
        while p >= 0 and step[p].get(c) == q:
            step[p][c] = new
            p = link[p]
        link[q] = new
        return new

    def scan(self, run: list[int]) -> tuple[list[tuple[int, int]], set[str]]:
        """Spans [start, end) of the windows in a run of known words, and the items they are of."""
        step, link, length, w, up = self.step, self.link, self.length, self.window, self.up
        v = n = 0
        spans, found = [], set()
        for i, c in enumerate(run):
            while v and c not in step[v]:
                v = link[v]
                n = length[v]
            if c in step[v]:
                v = step[v][c]
                n += 1
            else:
                n = 0
            if n >= w:
                u = v
                while length[link[u]] >= w:
                    u = link[u]
                spans.append((i + 1 - w, i + 1))
                found |= self.items.get(u, set())
            u = up[v]
            while u > 0:
                for k, names in self.short[u]:
                    if k <= n:
                        spans.append((i + 1 - k, i + 1))
                        found.update(names)
                u = up[link[u]]
        return spans, found


def automata(benchmark: DataFrame, window: int, max_words: int = MAX_WORDS) -> list:
    """Broadcast automata of the items, each of at most ``max_words`` words (one longer item goes alone)."""
    sc = benchmark.sparkSession.sparkContext
    group, n, out = [], 0, []

    def close() -> None:
        if group:
            out.append(sc.broadcast(SuffixAutomaton(group, window)))

    rows = benchmark.select(F.col("item_id").cast("string"), F.col("text").cast("string")).toLocalIterator()
    for name, text in rows:
        words = ALNUM_RE.findall(ascii_lower(text or ""))
        if not words:
            continue
        if n and n + len(words) > max_words:
            close()
            group, n = [], 0
        group.append(("null" if name is None else name, words))
        n += len(words)
    close()
    return out


def _batch_spans(text: pa.Array, sam: SuffixAutomaton):
    """Offsets of the words, a hit mark for each, and the items found per document."""
    flat, offsets = alnum_words(text)
    hit = np.zeros(len(flat), bool)
    found: dict[int, set[str]] = {}
    if len(flat) and sam.vocab:
        ids = pc.index_in(flat, value_set=pa.array(list(sam.vocab), pa.string()))
        ids = pc.fill_null(ids, -1).to_numpy()
        known = ids >= 0
        edge = np.zeros(len(flat) + 1, bool)
        edge[offsets] = True  # no run goes on into the next document
        start = np.flatnonzero(known & (edge[:-1] | ~np.concatenate([[False], known[:-1]])))
        end = np.flatnonzero(known & (edge[1:] | ~np.concatenate([known[1:], [False]]))) + 1
        long = end - start >= sam.least
        for a, b in zip(start[long].tolist(), end[long].tolist(), strict=True):
            spans, names = sam.scan(ids[a:b].tolist())
            if spans:
                for x, y in spans:
                    hit[a + x : a + y] = True
                found.setdefault(int(np.searchsorted(offsets, a, "right")) - 1, set()).update(names)
    return offsets, hit, found


def contamination(docs: DataFrame, benchmark: DataFrame, window: int = 10, id_col: str = "doc_id", max_words: int = MAX_WORDS) -> DataFrame:
    """Per document row: n_words, n_hit, n_items, items (sorted ids), items_sha256, contaminated, spans (word ranges, joined)."""
    prepare(docs.sparkSession)
    key = texts(docs, id_col)
    kind = key.schema["id"].dataType.simpleString()
    shared = automata(benchmark, window, max_words)

    def scan(batches):
        for b in (x for whole in batches for x in parts(whole, size=SLICE)):
            ids, text = b.column("id"), b.column("text")
            hits, items = None, [set() for _ in range(len(ids))]
            for sam in shared:  # one at a time; each is bounded
                offsets, hit, found = _batch_spans(text, sam.value)
                hits = hit if hits is None else hits | hit
                for i, names in found.items():
                    items[i] |= names
            if hits is None:
                offsets = alnum_words(text)[1]
                hits = np.zeros(int(offsets[-1]), bool)
            names = [sorted(x) for x in items]
            n_hit = np.add.reduceat(np.append(hits, False).astype(np.int64), offsets[:-1]) * (np.diff(offsets) > 0) if len(ids) else np.zeros(0, np.int64)
            spans = []
            for i, n in enumerate(n_hit.tolist()):
                if n:
                    own = np.concatenate([[0], hits[offsets[i] : offsets[i + 1]].astype(np.int8), [0]])
                    turn = np.flatnonzero(np.diff(own))
                    spans.append(turn.tolist())
                else:
                    spans.append([])
            yield pa.RecordBatch.from_arrays(
                [ids, pa.array(np.diff(offsets)), pa.array(n_hit), pa.array([len(x) for x in names], pa.int64()), pa.array(names, pa.list_(pa.string())), pa.array([hashlib.sha256(",".join(x).encode()).hexdigest() for x in names], pa.string()), pa.array(n_hit > 0), pa.array(spans, pa.list_(pa.int64()))],
                ["id", "n_words", "n_hit", "n_items", "items", "items_sha256", "contaminated", "spans"],
            )

    out = key.mapInArrow(lean(scan), f"id {kind}, n_words long, n_hit long, n_items long, items array<string>, items_sha256 string, contaminated boolean, spans array<long>")
    return out.withColumnRenamed("id", id_col)


def cut_spans(text: str, sam_hits: np.ndarray) -> str:
    """The text without the characters of the marked words and what stands between two of them."""
    out, at, last = [], 0, -2
    for i, m in enumerate(ALNUM_RE.finditer(ascii_lower(text))):  # as long as the text
        if sam_hits[i]:
            if last != i - 1:
                out.append(text[at : m.start()])
            at, last = m.end(), i
    out.append(text[at:])
    return "".join(out)


def decontaminate(docs: DataFrame, benchmark: DataFrame, window: int = 10, max_coverage: float = 0.5, max_words: int = MAX_WORDS) -> DataFrame:
    """The documents without benchmark passages, all columns kept.

    A document of which more than ``max_coverage`` of the words are hit goes;
    of the others the hit spans go from the text, and n_chars, where there is
    such a column, follows. Clean documents pass unchanged.
    """
    prepare(docs.sparkSession)
    shared = automata(benchmark, window, max_words)
    names = docs.columns

    def clean(batches):
        for b in (x for whole in batches for x in parts(whole, size=SLICE)):
            text = b.column(names.index("text"))
            hits = offsets = None
            for sam in shared:
                offsets, hit, _ = _batch_spans(text, sam.value)
                hits = hit if hits is None else hits | hit
            if hits is None or not hits.any():
                yield b
                continue
            n_hit = np.add.reduceat(np.append(hits, False).astype(np.int64), offsets[:-1]) * (np.diff(offsets) > 0)
            keep = n_hit <= max_coverage * np.diff(offsets)
            new = text.to_pylist()
            for i in np.flatnonzero((n_hit > 0) & keep):
                new[i] = cut_spans(new[i], hits[offsets[i] : offsets[i + 1]])
            columns = list(b.columns)
            columns[names.index("text")] = pa.array(new, pa.string())
            if "n_chars" in names:
                at = names.index("n_chars")
                changed = pa.array((n_hit > 0) & keep)
                columns[at] = pc.if_else(changed, pc.utf8_length(pa.array(new, pa.string())).cast(columns[at].type), columns[at])
            yield pa.RecordBatch.from_arrays(columns, names=b.schema.names).filter(pa.array(keep))

    return docs.mapInArrow(lean(clean), docs.schema)
