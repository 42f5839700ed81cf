"""Token counts by a compiled finite-state transducer of the tokenizer.

A byte-pair vocabulary whose pieces carry the space mark at their beginning
only splits a text into units: a run of marks with what follows up to the next
mark; characters of no piece stand alone, at one token a byte. Within a unit
the encoding of a prefix is the encoding of a shorter prefix plus one piece, so
a deterministic transducer counts tokens: its state is the longest suffix that
begins some piece, with the last piece and the relative count of each prefix
that this suffix spans; each transition carries the change of the count
(negative where pieces merge). Transitions are compiled when first met and
kept for the worker's life.

A text is cut into chunks at any place. The map of a chunk from the state it
is entered in is (head, count, tail): the open unit at either end and the
tokens of the units closed inside. These maps compose associatively, and
``scan_chunks`` folds them pairwise, in logarithmic depth.

Defined results: null and empty texts have no tokens; repeated rows and ids
are counted each; other columns are not looked at.
"""

from __future__ import annotations

import builtins
import re
import sys

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame

from .common import as_array, encode, mix64, prepare, segment_sums, texts, word_bytes

MARK = "▁"
#: Code points of a chunk; a longer text is cut and its chunk maps are composed.
CHUNK = 1 << 15
#: Compiled transitions a worker keeps before it starts anew: bounds memory.
MAX_TRANSITIONS = 800_000
SLOT_BITS = 21


class Transducer:
    """Counts the tokens of units under a vocabulary of scored pieces."""

    def __init__(self, scores: dict[str, float]):
        self.scores = scores
        begins: set[str] = set()
        for p in scores:
            begins.update(p[:k] for k in range(1, len(p)))
        self.begins = begins
        self.longest = max(map(len, scores), default=1)
        self.inside = {c for p in scores for c in p}
        # classes 0 to 3: characters of no piece, by their number of bytes
        self.chars = ["", *sorted(self.inside)]
        self.classes = np.repeat(np.arange(4, dtype=np.int32), [0x80, 0x780, 0xF800, 0x100000])
        for k, c in enumerate(self.chars[1:], 4):
            self.classes[ord(c)] = k
        self.rank = {p: k for k, p in enumerate(sorted(scores, key=lambda p: -scores[p]))}
        self.cut = {}  # where the last merge of each piece that an encoding can make is cut
        for p in scores:
            if len(p) > 1:
                parts, k = self._parts(p)
                if len(parts) == 1:
                    self.cut[p] = k
        self.reset()

    def reset(self) -> None:
        self.number: dict = {("", "", 0): 0}
        self.states: list = [("", "", 0)]
        self.slots = np.full(1 << SLOT_BITS, -1, np.int64)  # open addressing: state and class
        self.hops = np.zeros(1 << SLOT_BITS, np.int64)  # next state and tokens
        self.known: dict[tuple[int, int], int] = {}
        self.units: dict[str, int] = {}  # tokens of the units that long texts have had
        self.size = 0

    def _parts(self, s: str) -> tuple[list[str], int]:
        """The encoding of a short string by merging the best-scored adjacent pair, leftmost first, and where its last merge was cut."""
        parts, rank, cut = list(s), self.rank, 0
        while True:
            best, at = None, -1
            for i in range(len(parts) - 1):
                x = rank.get(parts[i] + parts[i + 1])
                if x is not None and (best is None or x < best):
                    best, at = x, i
            if at < 0:
                return parts, cut
            cut = len(parts[at])
            parts[at : at + 2] = [parts[at] + parts[at + 1]]

    def fits(self, last: str, piece: str) -> bool:
        """Whether ``piece`` can follow ``last`` in an encoding.

        It can't if, while the two are taken apart in reverse order of their
        merges, what meets at the border would have merged earlier.
        """
        rank, cut = self.rank, self.cut
        if piece not in cut and len(piece) > 1:
            return False  # no encoding makes this piece
        if not last:
            return True
        limit = len(rank) + 1
        while True:
            if rank.get(last + piece, limit) < limit:
                return False
            a = rank[last] if len(last) > 1 else -1
            b = rank[piece] if len(piece) > 1 else -1
            if a > b:
                limit, last = a, last[cut[last] :]
            elif b >= 0:
                limit, piece = b + 1, piece[: cut[piece]]
            else:
                return True

    def compile(self, state: int, k: int) -> int:
        """The transition from ``state`` on class ``k``: next state * 256 + emitted tokens + 128."""
        if k < 4:  # its bytes are tokens, and the next character begins anew
            return k + 1 + 128
        suffix, *history = self.states[state]  # history: last piece, count relative to now, for each prefix the suffix spans
        longer = suffix + self.chars[k - 3]
        m = len(longer)
        for start in range(max(0, m - self.longest), m):
            piece = longer[start:]
            if (piece in self.scores or start == m - 1) and self.fits(history[2 * start], piece):
                break
        else:
            raise AssertionError("no piece fits")
        emitted = history[2 * start + 1] + 1
        rest, first = [], m
        for i in range(m):  # prefixes where no piece that goes on can begin don't matter
            if longer[i:] in self.begins:
                first = min(first, i)
                rest += [history[2 * i], history[2 * i + 1] - emitted]
            elif first < m:
                rest += ["", 0]
        key = (sys.intern(longer[first:]), *rest, sys.intern(piece), 0)
        to = self.number.setdefault(key, len(self.states))
        if to == len(self.states):
            self.states.append(key)
        return to * 256 + emitted + 128

    def step(self, state: np.ndarray, cls: np.ndarray) -> np.ndarray:
        """Transitions of many (state, class) at once; those not met before are compiled."""
        key = state << 14 | cls
        mask = len(self.slots) - 1
        at = (mix64(key) & np.uint64(mask)).astype(np.int64)
        todo = np.arange(len(key))
        while len(todo):
            there = self.slots[at[todo]]
            miss = todo[there == -1]
            if len(miss):
                self._put(np.unique(key[miss]))
                there = self.slots[at[todo]]
            todo = todo[there != key[todo]]
            at[todo] = at[todo] + 1 & mask
        return self.hops[at]

    def _put(self, keys: np.ndarray) -> None:
        hops = np.fromiter((self.compile(k >> 14, k & 16383) for k in keys.tolist()), np.int64, len(keys))
        mask = len(self.slots) - 1
        at = (mix64(keys) & np.uint64(mask)).astype(np.int64)
        todo = np.arange(len(keys))
        while len(todo):  # of those that want one free slot the first gets it
            free = todo[self.slots[at[todo]] == -1]
            _, first = np.unique(at[free], return_index=True)
            got = free[first]
            self.slots[at[got]], self.hops[at[got]] = keys[got], hops[got]
            todo = np.setdiff1d(todo, got, assume_unique=True)
            at[todo] = at[todo] + (self.slots[at[todo]] != -1) & mask
        self.size += len(keys)

    def counts(self, units: pa.Array) -> np.ndarray:
        """Tokens of each of some units: all step at once, character by character."""
        n = pc.utf8_length(units).to_numpy().astype(np.int64)
        out = np.zeros(len(n), np.int64)
        if not len(n) or not n.max():
            return out
        raw, _ = word_bytes(units)
        cls = self.classes[np.frombuffer(raw.tobytes().decode().encode("utf-32-le"), np.uint32)]
        order = np.argsort(-n, kind="stable")
        begin = (np.cumsum(n) - n)[order]
        left = len(n) - np.searchsorted(np.sort(n), np.arange(int(n.max())), "right")  # units longer than i
        state = np.zeros(len(n), np.int64)
        for i, k in enumerate(left.tolist()):
            hop = self.step(state[:k], cls[begin[:k] + i].astype(np.int64))
            state[:k] = hop >> 8
            out[:k] += (hop & 255) - 128
        back = np.empty_like(out)
        back[order] = out
        return back

    def counted(self, units: pa.Array, block: int = 1 << 16) -> np.ndarray:
        """``counts`` by blocks; between two of them the transducer begins anew when it is full."""
        out = []
        for i in range(0, len(units), block):
            if self.size > MAX_TRANSITIONS:
                self.reset()
            out.append(self.counts(units[i : i + block]))
        return np.concatenate(out) if out else np.zeros(0, np.int64)

    def count(self, unit: str) -> int:
        """Tokens of one unit; those of short units are remembered, up to a bound."""
        n = self.units.get(unit)
        if n is None:
            n = self._count(unit)
            if len(unit) <= 32:
                if len(self.units) > MAX_TRANSITIONS // 8:
                    self.units.clear()
                self.units[unit] = n
        return n

    def _count(self, unit: str) -> int:
        state = n = 0
        for c in unit:
            k = int(self.classes[ord(c)])
            hop = self.known.get((state, k))
            if hop is None:
                if len(self.known) > MAX_TRANSITIONS // 8:
                    self.known.clear()
                hop = self.known[state, k] = self.compile(state, k)
            state = hop >> 8
            n += (hop & 255) - 128
        return n


def load(path: str) -> Transducer:
    """The transducer of a sentencepiece BPE model with byte fallback, kept per process."""
    cache = builtins.__dict__.setdefault("_linkwork_transducers", {})
    if path not in cache:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        plain = [i for i in range(sp.get_piece_size()) if not (sp.is_control(i) or sp.is_unknown(i) or sp.is_byte(i) or sp.is_unused(i))]
        scores = {sp.id_to_piece(i): sp.get_score(i) for i in plain}
        if any(re.search(f"[^{MARK}]{MARK}", p) for p in scores):
            raise ValueError("pieces cross the space mark; units can't be cut there")
        cache[path] = Transducer(scores)
        cache[path].prefix = sp.encode("a", out_type=str)[0].startswith(MARK)
    return cache[path]


# --- chunk maps -------------------------------------------------------------

_UNIT = re.compile(f"{MARK}+[^{MARK}]*")


def chunk_map(chunk: str, t: Transducer) -> tuple[str, int | None, str]:
    """(head, tokens of the closed units, tail); without a mark after its first unit a chunk is all head, the count None.

    A run of marks at the beginning may go on one of the chunk before, so it stays with the head.
    """
    lead = re.match(f"{MARK}*[^{MARK}]*", chunk).end()
    if lead == len(chunk):
        return chunk, None, ""
    units = _UNIT.findall(chunk[lead:])
    return chunk[:lead], sum(map(t.count, units[:-1])), units[-1]


def compose(a, b, t: Transducer):
    """The map of two adjacent chunks; what is open between them is closed as far as it can be."""
    (ha, na, ta), (hb, nb, tb) = a, b
    head, n, tail = chunk_map(ha + hb if na is None else ta + hb, t)
    if na is None:  # the joined head is the head of the whole
        if nb is None:
            return head, n, tail
        return (head, nb, tb) if n is None else (head, n + t.count(tail) + nb, tb)
    na += t.count(head) if n is not None else 0
    if n is None:  # still one open unit
        return (ha, na, head) if nb is None else (ha, na + t.count(head) + nb, tb)
    return (ha, na + n, tail) if nb is None else (ha, na + n + t.count(tail) + nb, tb)


def scan_chunks(text: str, t: Transducer, size: int = CHUNK) -> int:
    """Tokens of a text of any length: maps of its chunks, folded pairwise."""
    text = (MARK * t.prefix + text).replace(" ", MARK) if text else ""
    maps = [chunk_map(text[i : i + size], t) for i in range(0, len(text), size)]
    while len(maps) > 1:
        maps = [compose(*maps[i : i + 2], t) if i + 1 < len(maps) else maps[i] for i in range(0, len(maps), 2)]
    return sum(t.count(head) + (n or 0) + t.count(tail) for head, n, tail in maps)


# --- batches ----------------------------------------------------------------


def _unit_counts(plain: pa.Array, t: Transducer, runs: bool) -> np.ndarray:
    """Tokens of texts that are cut before each mark, or with ``runs`` before each run of marks."""
    if runs:
        plain = pc.replace_substring(plain, " ", MARK)
        if t.prefix:
            plain = pc.if_else(pc.equal(plain, ""), plain, pc.binary_join_element_wise(MARK, plain, ""))
        plain = pc.replace_substring_regex(plain, f"({MARK}+)", "\x00\\1")
    elif t.prefix:
        plain = pc.if_else(pc.equal(plain, ""), plain, pc.binary_join_element_wise("\x00" + MARK, pc.replace_substring(plain, " ", "\x00" + MARK), ""))
    else:
        plain = pc.replace_substring(plain, " ", "\x00" + MARK)
    if "\n" not in t.inside:  # stands alone anyway; without it there are fewer distinct units
        plain = pc.replace_substring(plain, "\n", "\x00\n\x00")
    lists = pc.split_pattern(plain, "\x00")
    offsets = lists.offsets.to_numpy().astype(np.int64)
    codes, units = encode(lists.flatten())
    return segment_sums(t.counted(units)[codes], offsets - offsets[0])


def batch_counts(text: pa.Array, t: Transducer, chunk: int = CHUNK) -> np.ndarray:
    """Tokens of each text of an Arrow array; distinct units are counted once."""
    text = as_array(text)
    odd = pc.match_substring(text, "\x00").to_numpy(zero_copy_only=False) | (pc.utf8_length(text).to_numpy() > chunk)  # the separator here, or several chunks
    runs = pc.starts_with(text, " ").to_numpy(zero_copy_only=False)
    for p in ("  ", MARK):  # runs of marks
        runs |= pc.match_substring(text, p).to_numpy(zero_copy_only=False)
    out = np.zeros(len(text), np.int64)
    for at in (~odd & ~runs, ~odd & runs):
        if at.any():
            out[at] = _unit_counts(text.filter(pa.array(at)), t, bool(runs[at][0]))
    for i in np.flatnonzero(odd):
        out[i] = scan_chunks(text[int(i)].as_py(), t, chunk)
    return out


def token_counts(docs: DataFrame, model_path: str, limit: int = 4096, id_col: str = "doc_id", chunk: int = CHUNK) -> DataFrame:
    """Per document row: n_bytes, n_tokens, over_limit (n_tokens > limit)."""
    prepare(docs.sparkSession)
    key = texts(docs, id_col)
    kind = key.schema["id"].dataType.simpleString()

    def count(batches):
        t = load(model_path)
        for b in batches:
            text = as_array(b.column("text"))
            n = batch_counts(text, t, chunk)
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(pc.binary_length(text)).cast(pa.int64()), pa.array(n), pa.array(n > limit)], ["id", "n_bytes", "n_tokens", "over_limit"])

    return key.mapInArrow(count, f"id {kind}, n_bytes long, n_tokens long, over_limit boolean").withColumnRenamed("id", id_col)
