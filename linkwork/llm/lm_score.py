"""Language-model scoring: online logistic mixing of hashed-context bit predictors.

Texts are words (A-Z lower-cased) and an end. The most frequent ``VOCAB`` words
have Huffman codes; one code word announces a word spelled in Huffman-coded
bytes. So a text is a sequence of bits, and each bit is predicted by several
predictors: counts of zeros and ones, over all training texts, in a slot chosen
by hashing the node of the code tree with a context.

words: no context; the word before; the last two of the 256 commonest words;
    how the word before ended, with the place in the text.
bytes: the two, three, four and six bytes before.

The predictions are mixed in the logistic domain by weights that a gate picks
(how much the context is known, and the depth in the tree). The weights start
from a Newton step on the coding cost of all training texts' words, and of the
letters of all distinct rare words, each bit's own count left out of its
predictions. The step's sums are added over tasks, so they do not depend on the
partitions. Weights of words are refined online along each text, by the gradient
of the coding cost, after every 64 words; those of letters are not, so that a
word costs the same everywhere. A text's score is the sum of
log10 of its bits' probabilities: a proper distribution over texts of words.
``bits_per_byte`` is the total cost over the text's bytes.

Letters are counted in each distinct rare word of the training texts once, however
these are partitioned. Counts of words cover all training texts and are summed by
shuffling words; the 2**18 commonest are broadcast, those of other words come
by a join. Tables of bit counts grow with the training tokens from 2**20 to
2**22 slots a word context (see ``table_bits``); each task sums its texts' and
they are added by blocks. What executors get is bounded.

Defined results: a null text is empty, which has its end alone; a null id counts
as the empty id when texts are held out; without training texts the base is
finite by its constants (V = N = 0) and words are spelled evenly; repeated
rows are scored each; other columns are not looked at.
"""

from __future__ import annotations

import heapq
from dataclasses import dataclass
from functools import partial

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import BATCH_BYTES, as_array, crc_mod, encode, materialise, prepare, release, segment_sums, space_words, texts, word_bytes, word_hashes

VOCAB, KNOWN = 1 << 15, 1 << 18
#: Bits of the slots of each predictor's table; those of the two word contexts (None) grow with the training tokens.
WORD_BITS, BYTE_BITS, LEAST_BITS, MOST_BITS = (16, None, None, 18), (18, 19, 20, 20), 20, 22
STEP = 64
#: Words that are worked on at once (twice as many letters): what numpy holds of them fits a core's cache.
PART = 1 << 12
#: Spelled words that a worker remembers (and about as many more).
SPELLED = 400_000
END_HASH = np.int64(0x5F3C_91E2_77A1_0B4D)
BLOCK = 1 << 16
#: All numbers of half precision, by their bits: looked up sooner than cast.
HALF = np.arange(1 << 16, dtype=np.uint16).view(np.float16).astype(np.float32)
COMMON = 256


class Tree:
    """A Huffman tree: for each symbol its nodes and bits from the root."""

    def __init__(self, counts: np.ndarray):
        n = len(counts)
        heap = [(float(c), i, i) for i, c in enumerate(counts)]
        heapq.heapify(heap)
        left, right, k = {}, {}, n
        while len(heap) > 1:
            (a, _, x), (b, _, y) = heapq.heappop(heap), heapq.heappop(heap)
            left[k], right[k] = x, y
            heapq.heappush(heap, (a + b, k, k))
            k += 1
        paths: list[tuple[list[int], list[int]]] = [([], []) for _ in range(n)]
        todo = [(heap[0][2], [], [])] if n else []
        while todo:
            x, nodes, bits = todo.pop()
            if x < n:
                paths[x] = (nodes, bits)
            else:
                own = nodes + [2 * n - 2 - x]  # the root is node 0
                todo += [(left[x], own, bits + [0]), (right[x], own, bits + [1])]
        self.length = np.array([len(p[0]) for p in paths], np.int64)
        self.start = np.concatenate([[0], np.cumsum(self.length)])[:-1]
        self.node = np.array([x for p in paths for x in p[0]], np.uint32)
        self.bit = np.array([x for p in paths for x in p[1]], np.uint8)
        # codes are cut in steps of at most four bits: the node that each begins with, and the bits' places in a subtree of 15 nodes
        depth = np.arange(len(self.bit)) - np.repeat(self.start, self.length)
        self.level, self.step = np.minimum(depth // 3, 3).astype(np.uint8), (depth // 4).astype(np.uint8)
        self.sub = np.ones(len(self.bit), np.uint8)
        for back in (1, 2, 3):
            inner = np.flatnonzero(depth % 4 >= back)
            self.sub[inner] += (1 << back - 1) + (self.bit[inner - back] << back - 1)
        self.steps = -(-self.length // 4)
        self.first = np.cumsum(self.steps) - self.steps
        self.root = self.node[np.flatnonzero(depth % 4 == 0)]

    def expand(self, symbols: np.ndarray) -> Bits:
        n, m = self.length[symbols], self.steps[symbols]
        ends, step_ends = np.cumsum(n), np.cumsum(m)
        at = np.repeat(self.start[symbols] - ends + n, n)
        at += np.arange(len(at))
        step = np.repeat(step_ends - m, n)
        step += self.step.take(at, mode="clip")
        step_at = np.repeat(self.first[symbols] - step_ends + m, m)
        step_at += np.arange(len(step_at))
        return Bits(self, n, at, self.bit.take(at, mode="clip"), self.sub.take(at, mode="clip"), step, np.repeat(np.arange(len(symbols)), m), self.root[step_at])


@dataclass
class Bits:
    """Bits of some symbols' codes: how many of each, their places in the tree's codes, the bits, places in their steps' subtrees, steps; and of each step its owner and first node."""

    tree: Tree
    n: np.ndarray
    at: np.ndarray
    bit: np.ndarray
    sub: np.ndarray
    step: np.ndarray
    step_owner: np.ndarray
    root: np.ndarray

    def spread(self, values: np.ndarray) -> np.ndarray:
        """The symbols' values, for each bit."""
        return np.repeat(values, self.n)


def slot(context: np.ndarray, node: np.ndarray, salt: int, bits: int) -> np.ndarray:
    x = context.astype(np.uint32) * np.uint32(0x9E3779B1) + node * np.uint32(0x85EBCA6B) + np.uint32(salt * 0x27D4EB2F & 0xFFFFFFFF)
    x ^= x >> np.uint32(15)
    x *= np.uint32(0x2C1B3C6D)
    x ^= x >> np.uint32(13)
    return x >> np.uint32(32 - bits)


@dataclass
class Code:
    """The two trees and the numbers of the words: sorted hashes and their numbers by falling frequency."""

    hashes: np.ndarray
    numbers: np.ndarray
    words: Tree
    letters: Tree
    escape: int
    end: int

    def number(self, h: np.ndarray) -> np.ndarray:
        if not len(self.hashes):
            return np.full(len(h), self.escape)
        at = np.minimum(np.searchsorted(self.hashes, h), len(self.hashes) - 1)
        return np.where(self.hashes[at] == h, self.numbers[at], self.escape)


class Batch:
    """Words of some texts with their ends: numbers, contexts, and the distinct words to spell."""

    def __init__(self, text: pa.Array, code: Code):
        flat, off = space_words(text)
        codes, words = encode(flat)
        hashes = word_hashes(words).view(np.int64)
        own = code.number(hashes)
        raw, w_off = word_bytes(words)
        last = raw[w_off[1:] - 1].astype(np.int64) if len(words) else np.zeros(0, np.int64)
        second = np.where(np.diff(w_off) > 1, raw[np.maximum(w_off[1:] - 2, 0)], 0).astype(np.int64) if len(words) else last
        n_docs = len(off) - 1
        self.off = off + np.arange(n_docs + 1)
        total = int(self.off[-1])
        self.doc = np.repeat(np.arange(n_docs), np.diff(self.off))
        self.place = np.arange(total) - self.off[:-1][self.doc]
        # the end is one more distinct word; as the word before, it is the start of the next text
        self.word = np.full(total, len(words), np.int64)
        self.word[np.arange(len(codes)) + np.repeat(np.arange(n_docs), np.diff(off))] = codes
        self.ids = np.append(own, code.end)[self.word]
        self.hash = np.append(hashes, END_HASH)[self.word]
        # context of each word as the one before: its number, or how a spelled word ends; and how it ended
        seen = np.append(np.where(own == code.escape, VOCAB + 8 + (last * 7 + second) % 512, own), VOCAB + 4).astype(np.uint32)
        ending = np.append(np.select([last == b for b in b".,|!?*$"], range(1, 8), 8), 0).astype(np.uint32)
        before = np.append(len(words), self.word)[:total]
        # the last common word before each place, and the one before that, within the text: COMMON where there is none
        common = np.append(np.where(own < COMMON, own, -1), COMMON)
        value = common[self.word]
        at = np.flatnonzero(value >= 0)
        one = np.append(COMMON, value[at])
        two = np.where(one == COMMON, COMMON, np.append(COMMON, one[:-1]))
        pair = np.repeat((one * (COMMON + 1) + two).astype(np.uint32), np.diff(np.concatenate([[0], at + 1, [total]])))
        turn = ending[before] * np.uint32(32) + np.log2(self.place + 1).astype(np.uint32)
        self.contexts = [np.zeros(total, np.uint32), seen[before], pair, turn]
        # spelling, of distinct words only
        self.rare = np.flatnonzero(own == code.escape)
        self.rare_row = np.full(len(words) + 1, -1, np.int64)
        self.rare_row[self.rare] = np.arange(len(self.rare))
        self.rare_hash = hashes[self.rare]
        self._bytes = (raw, w_off)

    def spell(self, keep: np.ndarray | None = None) -> None:
        """Letters of all rare words or of the kept ones, each closed by an end mark."""
        raw, w_off = self._bytes
        rare = self.rare if keep is None else self.rare[keep]
        lens = np.diff(w_off)[rare]
        self.letters = np.zeros(int(lens.sum() + len(lens)), np.int64)
        self.spell_off = np.concatenate([[0], np.cumsum(lens + 1)])
        inner = np.ones(len(self.letters), bool)
        inner[self.spell_off[1:] - 1] = False
        owner = np.repeat(np.arange(len(lens)), lens)
        self.letters[inner] = raw[np.repeat(w_off[:-1][rare], lens) + np.arange(len(owner)) - np.repeat(np.cumsum(lens) - lens, lens)].astype(np.int64) + 1 if len(raw) else 0
        self.spell_word = np.repeat(np.arange(len(lens)), lens + 1)
        self.spell_place = np.arange(len(self.letters)) - self.spell_off[:-1][self.spell_word]

    def spell_contexts(self, a: int, b: int) -> list[np.ndarray]:
        """Hashes of the 2, 3, 4 and 6 bytes before the letters a to b (whole words)."""
        x, place = self.letters[a:b], self.spell_place[a:b]
        value, out = np.zeros(b - a, np.uint32), []
        for k in range(1, 7):
            back = np.zeros(b - a, np.uint32)
            back[k:] = x[: len(x) - k]
            back[place < k] = 300
            value = value * np.uint32(0x01000193) + back + np.uint32(1)
            if k in (2, 3, 4, 6):
                out.append(value)
        return out


def table_bits(tokens: int) -> tuple[int, ...]:
    """Bits of all predictors' slots: word contexts get a slot for each 8 to 16 training tokens, between the bounds."""
    grown = min(max(tokens.bit_length() - 3, LEAST_BITS), MOST_BITS)
    return (*(b or grown for b in WORD_BITS), *BYTE_BITS)


def stretch(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    return np.clip(np.log((n1 + 0.4) / (n0 + 0.4)), -8, 8).astype(np.float32)


class Tables:
    """Counts of zeros and ones in the slots of all predictors, or logits made of them (of half precision, which is what executors get)."""

    def __init__(self, bits: tuple[int, ...], counts: np.ndarray):
        self.bits, self.counts = bits, counts
        self.sizes = [1 << b for b in bits]
        self.offsets = np.concatenate([[0], np.cumsum(self.sizes)])

    def _pieces(self):
        """The counts in parts of a bounded size: bounds what is held in floats at once."""
        for i in range(0, len(self.counts) // 2, BLOCK):
            yield slice(i, i + BLOCK), self.counts[2 * i : 2 * (i + BLOCK)].reshape(-1, 2).astype(np.float64)

    def frozen(self) -> Tables:
        """Logits and sureness of each slot, for scoring."""
        n = len(self.counts) // 2
        out = Tables(self.bits, None)
        out.logit, out.sure = np.empty(n, np.float16), np.empty(n, np.uint8)
        for at, c in self._pieces():
            out.logit[at] = stretch(c[:, 0], c[:, 1])
            out.sure[at] = sureness(c.sum(1))
        return out

    def left_out(self) -> Tables:
        """The same with one bit less, for learning: logits by slot and by the bit that is left out."""
        n = len(self.counts) // 2
        out = Tables(self.bits, None)
        out.logit, out.sure = np.empty((n, 2), np.float16), np.empty(n, np.uint8)
        for at, c in self._pieces():
            less = np.maximum(c - 1, 0)
            out.logit[at, 0], out.logit[at, 1] = stretch(less[:, 0], c[:, 1]), stretch(c[:, 0], less[:, 1])
            out.sure[at] = sureness(np.maximum(c.sum(1) - 1, 0))
        out.logit = out.logit.reshape(-1)
        return out


def sureness(n: np.ndarray) -> np.ndarray:
    return np.minimum(np.log2(n + 1) / 2, 5).astype(np.uint8)


#: Gates: how sure the leading context is (6), by depth or place (4).
GATES, LEAD = 24, (1, 2)


class Mixer:
    """Predicts bits from slots by gated weights (a column each) and learns from them."""

    def __init__(self, tables: Tables, letters: bool):
        self.t, self.part = tables, 4 * letters

    def slots(self, contexts: list[np.ndarray], bits: Bits) -> list[np.ndarray]:
        return [self.slots_of(k, c, bits) for k, c in enumerate(contexts)]

    def slots_of(self, k: int, context: np.ndarray, bits: Bits) -> np.ndarray:
        """A step's context is hashed once; its bits go to slots beside each other, by exclusive or with their places."""
        base = slot(context[bits.step_owner], bits.root, k, self.t.bits[self.part + k]).astype(np.int64) + self.t.offsets[self.part + k]
        base = base.take(bits.step, mode="clip")
        base ^= bits.sub
        return base

    def inputs(self, slots: list[np.ndarray], level: np.ndarray, left_out: np.ndarray | None = None, first: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """Logits of the predictors (and a constant), a row each, and the gate of each bit; bits to leave out need the tables for it. Overwrites ``slots``, which lack the first predictor's where its logits are given."""
        x = np.empty((5, len(level)), np.float32)
        x[4] = 0.3
        skip = 0 if first is None else 1
        gate = self.t.sure.take(slots[LEAD[self.part > 0] - skip], mode="clip")
        gate *= np.uint8(4)
        gate += level.astype(np.uint8)
        if skip:
            x[0] = first
        half = self.t.logit.view(np.uint16)
        for k, s in enumerate(slots, skip):
            if left_out is not None:
                s *= 2
                s += left_out
            np.take(HALF, half.take(s, mode="clip"), out=x[k], mode="clip")
        return x, gate

    def word_inputs(self, contexts: list[np.ndarray], bits: Bits, left_out: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray]:
        """``inputs`` of words with their contexts, of which the first says nothing: its logits are those of the code's places."""
        slots = [self.slots_of(k, contexts[k], bits) for k in range(1, len(contexts))]
        return self.inputs(slots, bits.tree.level.take(bits.at, mode="clip"), left_out, self._plain(bits.tree, left_out is not None).take(bits.at, mode="clip"))

    def _plain(self, tree: Tree, left_out: bool) -> np.ndarray:
        """Logits of the predictor without a context at all places of the tree's codes, in their order; kept with the tables."""
        kept = self.t.__dict__.setdefault("_plain", {})
        if left_out not in kept:
            bits = tree.expand(np.arange(len(tree.length)))
            s = self.slots_of(0, np.zeros(len(tree.length), np.uint32), bits)
            kept[left_out] = self.t.logit[2 * s + bits.bit if left_out else s].astype(np.float32)
        return kept[left_out]

    @staticmethod
    def predict(x: np.ndarray, w: np.ndarray, row: np.ndarray, bit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Cost in bits' natural logs, and the error of the prediction, with weights w[:, row]."""
        z, own = np.take(w[0], row, mode="clip"), np.empty(len(row), np.float32)
        z *= x[0]
        for k in range(1, len(x)):
            np.take(w[k], row, out=own, mode="clip")
            own *= x[k]
            z += own
        np.clip(z, -12, 12, out=z)
        sign = 1 - 2 * bit.astype(np.float32)
        z *= sign  # for the bit that came: the lower, the likelier
        e = np.exp(-np.abs(z))
        both = 1 + e
        wrong = np.where(z >= 0, 1, e)
        wrong /= both
        return np.log(both) + np.maximum(z, 0), -sign * wrong

    @staticmethod
    def learn(w: np.ndarray, x: np.ndarray, row: np.ndarray, error: np.ndarray, rate: float) -> None:
        for k in range(len(x)):
            w[k] += rate * np.bincount(row, error * x[k], w.shape[1]).astype(np.float32)


def count_words(batch: Batch, code: Code, tables: Tables) -> None:
    """Adds the bits of the batch's words to the counts; a word that recurs in a context is looked up once."""
    mixer, size, symbols = Mixer(tables, False), 1 << 15, len(code.words.length)
    for k, context in enumerate(batch.contexts):
        if k:
            pair, times = np.unique(context.astype(np.int64) * symbols + batch.ids, return_counts=True)
        else:  # no context
            times = np.bincount(batch.ids, minlength=symbols)
            pair = np.flatnonzero(times)
            times = times[pair]
        for i in range(0, len(pair), size):
            bits = code.words.expand(pair[i : i + size] % symbols)
            s = mixer.slots_of(k, (pair[i : i + size] // symbols).astype(np.uint32), bits)
            np.add.at(tables.counts, 2 * s + bits.bit, bits.spread(times[i : i + size].astype(np.int32)))


def count_letters(batch: Batch, code: Code, tables: Tables) -> None:
    """Adds the bits of the batch's distinct rare words to the counts."""
    mixer, symbols = Mixer(tables, True), len(code.letters.length)
    batch.spell()
    for a, b in _spell_chunks(batch, 1 << 17):
        for k, context in enumerate(batch.spell_contexts(a, b)):
            pair, times = np.unique(context.astype(np.int64) * symbols + batch.letters[a:b], return_counts=True)
            bits = code.letters.expand(pair % symbols)
            s = mixer.slots_of(k, (pair // symbols).astype(np.uint32), bits)
            np.add.at(tables.counts, 2 * s + bits.bit, bits.spread(times.astype(np.int32)))


def _spell_chunks(batch: Batch, size: int = 2 * PART):
    """Ranges of letters of whole words."""
    a = 0
    while a < len(batch.letters):
        b = int(batch.spell_off[np.searchsorted(batch.spell_off, min(a + size, len(batch.letters)), "left")])
        yield a, b
        a = b


def first_weights() -> np.ndarray:
    return np.full((5, GATES), 0.3, np.float32)


def word_sums(batch: Batch, code: Code, tables: Tables) -> np.ndarray:
    """``newton_sums`` of the batch's words."""
    mixer, total = Mixer(tables, False), np.zeros((GATES, 5, 6))
    # sums know no order, and words of one context meet the same slots
    order = np.argsort(batch.contexts[LEAD[0]], kind="stable")
    for a in range(0, len(order), PART):
        at = order[a : a + PART]
        bits = code.words.expand(batch.ids[at])
        x, gate = mixer.word_inputs([c[at] for c in batch.contexts], bits, bits.bit)
        newton_sums(total, x, gate, bits.bit)
    return total


def letter_sums(batch: Batch, code: Code, tables: Tables) -> np.ndarray:
    """``newton_sums`` of the letters of the batch's distinct rare words."""
    mixer, total = Mixer(tables, True), np.zeros((GATES, 5, 6))
    batch.spell()
    for a, b in _spell_chunks(batch):
        bits = code.letters.expand(batch.letters[a:b])
        x, gate = mixer.inputs(mixer.slots(batch.spell_contexts(a, b), bits), bits.spread(np.minimum(batch.spell_place[a:b], 3)), bits.bit)
        newton_sums(total, x, gate, bits.bit)
    return total


def newton_sums(total: np.ndarray, x: np.ndarray, gate: np.ndarray, bit: np.ndarray) -> None:
    """Adds each gate's second derivatives (5 by 5) and gradient (the last column) of the bits' cost at the first weights."""
    z = np.clip(0.3 * x.sum(0), -12, 12)
    p = 1 / (1 + np.exp(-z))
    order = np.argsort(gate.astype(np.uint8), kind="stable")
    edge = np.concatenate([[0], np.cumsum(np.bincount(gate, minlength=GATES))])
    # in doubles, so that the order of the texts does not show in the weights
    own, bent = np.empty((5, len(order))), np.empty((6, len(order)))
    for k in range(5):
        own[k] = x[k].take(order, mode="clip")
    curve = (p * (1 - p)).take(order, mode="clip").astype(np.float64)
    np.multiply(own, curve, out=bent[:5])
    bent[5] = (bit - p).take(order, mode="clip")
    for g in np.flatnonzero(np.diff(edge)):
        at = slice(edge[g], edge[g + 1])
        total[g] += own[:, at] @ bent[:, at].T


def newton(total: np.ndarray) -> np.ndarray:
    """The weights after a step from the first ones, which a gate of few bits hardly leaves."""
    step = np.linalg.solve(total[:, :, :5] + 10 * np.eye(5), total[:, :, 5:])[:, :, 0]
    return (first_weights() + step.T).astype(np.float32)


@dataclass
class Model:
    code: Code
    tables: Tables
    words: np.ndarray
    letters: np.ndarray
    rate: float = 0.0015

    def spell_costs(self, batch: Batch) -> np.ndarray:
        """Natural-log cost of spelling each distinct rare word; those of this task's batches before are remembered, up to a bound."""
        names, known = self.__dict__.setdefault("_spelled", (np.zeros(0, np.int64), np.zeros(0)))
        at = np.minimum(np.searchsorted(names, batch.rare_hash), max(len(names) - 1, 0))
        old = names[at] == batch.rare_hash if len(names) else np.zeros(len(batch.rare_hash), bool)
        out = np.zeros(len(batch.rare_hash))
        out[old] = known[at[old]]
        if not old.all():
            batch.spell(~old)
            out[~old] = self._spell(batch)
            if len(names) < SPELLED:
                names, known = np.concatenate([names, batch.rare_hash[~old]]), np.concatenate([known, out[~old]])
                order = np.argsort(names)
                self._spelled = (names[order], known[order])
        return out

    def _spell(self, batch: Batch) -> np.ndarray:
        out = [np.zeros(0)]
        m = Mixer(self.tables, True)
        for a, b in _spell_chunks(batch):
            bits = self.code.letters.expand(batch.letters[a:b])
            x, gate = m.inputs(m.slots(batch.spell_contexts(a, b), bits), bits.spread(np.minimum(batch.spell_place[a:b], 3)))
            cost, _ = m.predict(x, self.letters, gate, bits.bit)
            word = bits.spread(batch.spell_word[a:b] - batch.spell_word[a])
            out.append(np.bincount(word, cost, int(batch.spell_word[b - 1] - batch.spell_word[a]) + 1))
        return np.concatenate(out)

    def costs(self, batch: Batch) -> np.ndarray:
        """Natural-log cost of each text, the weights refined along it."""
        n_docs = len(batch.off) - 1
        total = np.zeros(n_docs)
        rare = batch.ids == self.code.escape
        if rare.any():
            spell = self.spell_costs(batch)
            total += np.bincount(batch.doc[rare], spell[batch.rare_row[batch.word[rare]]], n_docs)
        block = batch.place // STEP
        order = np.argsort(block, kind="stable")
        edge = np.searchsorted(block[order], np.arange(int(block.max(initial=-1)) + 2))
        weights = np.tile(self.words, (1, n_docs))  # column: text * GATES + gate
        m = Mixer(self.tables, False)
        for a, z in zip(edge[:-1].tolist(), edge[1:].tolist(), strict=True):
            docs = batch.doc[order[a:z]]
            while a < z:
                # parts of a block end between texts, so that a text learns once, after its block, whatever its neighbours
                end = z if z - a <= PART else a + int(np.searchsorted(docs, docs[PART], "left"))
                at, doc = order[a:end], docs[: end - a]
                bits = self.code.words.expand(batch.ids[at])
                x, gate = m.word_inputs([c[at] for c in batch.contexts], bits)
                low, high = int(doc[0]), int(doc[-1]) + 1
                near = bits.spread(doc - low)
                row = near * GATES + gate
                own = weights[:, low * GATES : high * GATES]
                cost, error = m.predict(x, own, row, bits.bit)
                total[low:high] += np.bincount(near, cost, high - low)
                m.learn(own, x, row, error, self.rate)
                docs, a = docs[end - a :], end
        return total


# --- Spark ------------------------------------------------------------------


def word_totals(key: DataFrame) -> DataFrame:
    """(h, word, c): how often each word, and the end (an empty word), occurs in the texts; a written table."""

    def run(batches):
        docs = 0
        for b in batches:
            flat, _ = space_words(b.column("text"))
            codes, words = encode(flat)
            docs += b.num_rows
            yield pa.RecordBatch.from_arrays([pa.array(word_hashes(words).view(np.int64)), words, pa.array(np.bincount(codes, minlength=len(words)).astype(np.int64))], ["h", "word", "c"])
        if docs:
            yield pa.RecordBatch.from_arrays([pa.array([END_HASH]), pa.array([""]), pa.array([docs], pa.int64())], ["h", "word", "c"])
        release()

    return materialise(key.mapInArrow(run, "h long, word string, c long").groupBy("h", "word").agg(F.sum("c").alias("c")))


def rare_words(totals: DataFrame, known: np.ndarray) -> DataFrame:
    """(text): each counted word outside ``known`` once."""
    shared = totals.sparkSession.sparkContext.broadcast(known)

    def run(batches):
        for b in batches:
            rare = ~np.isin(b.column("h").to_numpy(), shared.value, kind="sort")
            yield pa.RecordBatch.from_arrays([b.column("word").filter(pa.array(rare))], ["text"])

    return totals.where("word <> ''").select("h", "word").mapInArrow(run, "text string")


def byte_totals(rare: DataFrame) -> np.ndarray:
    """How often each byte, and the end of a word, occurs in the distinct rare words."""

    def run(batches):
        total = np.zeros(257, np.int64)
        for b in batches:
            raw, off = word_bytes(as_array(b.column("text")))
            total[1:] += np.bincount(raw, minlength=256)
            total[0] += len(off) - 1
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(257)), pa.array(total)], ["k", "n"])

    out = np.zeros(257)
    for r in rare.mapInArrow(run, "k long, n long").groupBy("k").agg(F.sum("n").alias("n")).collect():
        out[r.k] = r.n
    return out


def bit_totals(key: DataFrame, rare: DataFrame, code: Code, bits: tuple[int, ...]) -> np.ndarray:
    """Counts of all slots, of the texts' words and the distinct rare words' letters, summed over tasks block by block."""
    shared = key.sparkSession.sparkContext.broadcast(code)
    size = 2 * sum(1 << b for b in bits)

    def run(batches, count):
        tables = Tables(bits, np.zeros(size, np.int32))
        for b in batches:
            for part in slices(b.column("text")):
                count(Batch(part, shared.value), shared.value, tables)
        for i in range(0, size, BLOCK):
            own = tables.counts[i : i + BLOCK]
            if own.any():
                yield row(i // BLOCK, own)
        del tables
        release()

    def merge(batches):
        held, total = None, None
        for b in batches:
            for k, data in zip(b.column("block").to_pylist(), b.column("data"), strict=True):
                if k != held:
                    if held is not None:
                        yield row(held, total)
                    held, total = k, np.zeros(min(BLOCK, size - k * BLOCK), np.int64)
                total += np.frombuffer(pa.decompress(data.as_py(), len(total) * 4, "zstd"), np.int32)
        if held is not None:
            yield row(held, total)

    def row(k: int, total: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array([k]), pa.array([pa.compress(np.minimum(total, 2**31 - 1).astype(np.int32).tobytes(), "zstd", asbytes=True)], pa.binary())], ["block", "data"])

    blocks = [d.select("text").mapInArrow(partial(run, count=count), "block long, data binary") for d, count in ((key, count_words), (rare, count_letters))]
    summed = blocks[0].unionByName(blocks[1]).repartition(F.col("block")).sortWithinPartitions("block").mapInArrow(merge, "block long, data binary").toArrow()
    out = np.zeros(size, np.int32)
    for k, data in zip(summed["block"].to_pylist(), summed["data"], strict=True):
        n = min(BLOCK, size - k * BLOCK)
        out[k * BLOCK : k * BLOCK + n] = np.frombuffer(pa.decompress(data.as_py(), n * 4, "zstd"), np.int32)
    return out


def weights(d: DataFrame, shared, sums) -> np.ndarray:
    """Weights after a Newton step over all texts of ``d``; a task gives some 700 numbers."""

    def run(batches):
        total = np.zeros((GATES, 5, 6))
        for b in batches:
            code, tables = shared.value
            for part in slices(b.column("text")):
                total += sums(Batch(part, code), code, tables)
        release()
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(total.size), pa.int32()), pa.array(total.ravel())], ["k", "w"])

    total = np.zeros((GATES, 5, 6))
    for r in d.select("text").mapInArrow(run, "k int, w double").groupBy("k").agg(F.sum("w").alias("w")).collect():
        total.flat[r.k] = r.w
    return newton(total)


def slices(text: pa.Array, size: int = BATCH_BYTES // 8):
    """The array in parts of about ``size`` bytes."""
    text = as_array(text)
    at = np.cumsum(pc.binary_length(text).to_numpy().astype(np.int64)) // size
    cuts = np.concatenate([[0], np.flatnonzero(np.diff(at)) + 1, [len(text)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        if b > a:
            yield text[a:b]


def fit(key: DataFrame, totals: DataFrame, n: int) -> Model:
    """The model of training texts ``key`` (id, text), whose words are counted in ``totals``."""
    top = totals.select("h", "c").orderBy(F.col("c").desc(), "h").limit(VOCAB).toArrow()
    h, c = top["h"].to_numpy(), top["c"].to_numpy()
    ends = int(np.flatnonzero(h == END_HASH)[0]) if (h == END_HASH).any() else -1
    order = np.argsort(h)
    counts = np.append(c, max(n - int(c.sum()), 1))
    end = ends if ends >= 0 else len(counts)
    if ends < 0:
        counts = np.append(counts, 1)
    rare = rare_words(totals, h)
    code = Code(h[order], order, Tree(counts), Tree(byte_totals(rare) + 1), len(c), end)
    bits = table_bits(n)
    tables = Tables(bits, bit_totals(key, rare, code, bits))
    shared = key.sparkSession.sparkContext.broadcast((code, tables.left_out()))
    words, letters = weights(key, shared, word_sums), weights(rare, shared, letter_sums)
    shared.unpersist()
    return Model(code, tables.frozen(), words, letters)


def score(docs: DataFrame, folds: int = 10, id_col: str = "doc_id") -> DataFrame:
    """Per document row: held_out, n_tokens, n_known, train_tokens, base_score, score, bits_per_byte."""
    spark = prepare(docs.sparkSession)
    key = texts(docs, id_col)
    kind = key.schema["id"].dataType.simpleString()
    training = key.where(crc_mod(F.col("id"), folds) != 0)
    totals = word_totals(training)
    n, v = totals.agg(F.coalesce(F.sum("c"), F.lit(0)), F.count("*")).first()
    floor = float(np.log10(n + 0.1 * (v + 1)))
    model = fit(training, totals, n)
    known = totals.select("h", "c").orderBy(F.col("c").desc(), "h").limit(KNOWN).toArrow().sort_by("h")
    shared = spark.sparkContext.broadcast((model, known["h"].to_numpy(), known["c"].to_numpy()))

    def run(batches):
        model, top, count = shared.value
        task, row = TaskContext.get().partitionId() << 36, 0
        for b in batches:
            ids = b.column("id")
            start = 0
            for part in slices(b.column("text")):
                batch = Batch(part, model.code)
                cost = model.costs(batch) / np.log(10)
                at = np.minimum(np.searchsorted(top, batch.hash), max(len(top) - 1, 0))
                hit = top[at] == batch.hash if len(top) else np.zeros(len(batch.hash), bool)
                base = np.zeros(len(batch.hash))
                base[hit] = np.log10(count[at[hit]] + 0.1) - floor
                rest = np.concatenate([[0], np.cumsum(~hit)])[batch.off].astype(np.int32)
                n_docs = len(part)
                yield pa.RecordBatch.from_arrays(
                    [ids[start : start + n_docs], pa.array(task + row + np.arange(n_docs)), pa.array(np.diff(batch.off)), pa.array(segment_sums(hit.astype(np.int64), batch.off)), pa.array(segment_sums(base, batch.off)), pa.array(-cost), pa.array(cost / np.log10(2) / np.maximum(pc.binary_length(part).to_numpy(), 1)), pa.ListArray.from_arrays(pa.array(rest), pa.array(batch.hash[~hit]))],
                    ["id", "row", "n_tokens", "n_top", "base_top", "score", "bits_per_byte", "rest"],
                )
                start += n_docs
                row += n_docs
        release()

    scored = materialise(key.mapInArrow(run, f"id {kind}, row long, n_tokens long, n_top long, base_top double, score double, bits_per_byte double, rest array<long>"))
    # the words outside the broadcast counts get theirs by a join; equal words meet as a few rows of each task
    rest = scored.select("row", F.explode("rest").alias("h")).join(totals.select("h", "c"), "h", "left")
    rest = rest.groupBy("row").agg(F.sum(F.log10(F.coalesce("c", F.lit(0)) + F.lit(0.1)) - F.lit(floor)).alias("base_rest"), F.count("c").alias("n_rest"))
    out = scored.drop("rest").join(rest, "row", "left")
    return out.select(
        F.col("id").alias(id_col),
        (crc_mod(F.col("id"), folds) == 0).alias("held_out"),
        "n_tokens",
        (F.col("n_top") + F.coalesce("n_rest", F.lit(0))).alias("n_known"),
        F.lit(n).cast("long").alias("train_tokens"),
        (F.col("base_top") + F.coalesce("base_rest", F.lit(0.0))).alias("base_score"),
        "score",
        "bits_per_byte",
    )
