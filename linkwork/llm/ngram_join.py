"""N-gram Jaccard join: classes of documents whose shingle sets are alike.

Two documents link when their sets of word shingles have a Jaccard similarity
of at least ``percent``/100, exactly; the result is connected components.

1. Every text becomes its set of hashed shingles. Equal sets are one node (a
   64-bit hash of the set), so copies cost one node however many there are.
2. The hashes of a set are dealt to groups, more than two linked sets of about
   that size can differ in. So linked sets have a group that is equal and not
   empty: its hash is a bucket that both stand in. A set with more empty groups
   than the number of groups allows for is also dealt by another salt, and after
   ``SALTS`` of them by its least shingles (of which linked sets share one). A
   passage that many documents share fills few groups wholly, so it makes few
   buckets, whatever the size of the corpus; nothing is counted or ordered by
   frequency.
3. In rounds, every bucket that holds several classes has a leader, its least
   node by an order of the round, and every node is compared with the leader of
   most of its buckets. The links found contract classes, and buckets of one
   class go. So a group of near
   copies costs a pair a node and round, and not the square of its size.
4. What is left are pairs between different classes of a bucket. Its nodes are
   points: the counts of their shingles in 256 hash groups. An R-tree over them
   bounds the overlap of two nodes, or of two boxes, by the summed coordinate
   minima; boxes of one class, or which can't reach the least overlap, are not
   opened. A large bucket is split into pairs of its parts, and a pair is taken
   in the first bucket that both have. Pairs that survive, here and in the
   rounds, are verified on their shingles, so nothing is lost.
5. Before all of those pairs are taken, each node is compared with the ``NEAR``
   of the largest bounds in the largest of its buckets. So texts that few others
   are alike to, but of which chains hold together a large group, mostly become
   one class for some pairs a node.

Defined results: null, empty and wordless texts have no shingles and link with
nothing (component: the own id); with fewer words than a shingle the whole
sequence is one; rows of equal id are placed each; a null id never names a
component unless all its ids are null; other columns are not looked at.
"""

from __future__ import annotations

from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import encode, lean, materialise, mix64, parts, prepare, space_words, texts, word_hashes

#: Groups of the count vectors, points of a leaf, bytes of text that Python works on at once.
GROUPS, LEAF, SLICE = 256, 48, 2 << 20
#: Of a node's buckets those that tell where a pair has met before.
EARLY = 24
#: Ways to deal a set to groups before its least shingles are taken; rounds: of leaders, of the nearest, of the rest.
SALTS, ROUNDS = 6, 3
#: Others that a node is compared with in a round of the nearest.
NEAR = 3
#: Rows of node ids up to which they are broadcast to pick their texts; beyond, the join shuffles.
BROADCAST_NODES = 1_000_000
#: Members that are compared with one leader in a task, and nodes of a part of a bucket.
STAR, PART = 256, 4096


def shingle_hashes(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all shingles of each text, one after the other, and their offsets."""
    flat, off = space_words(text)
    codes, words = encode(flat)
    h = word_hashes(words)[codes]
    n = np.diff(off)
    count = np.where(n >= width, n - width + 1, np.minimum(n, 1))
    out_off = np.concatenate([[0], np.cumsum(count)])
    if not len(h):
        return np.zeros(0, np.uint64), out_off
    # sums of the words' hashes, each place in the shingle with its own odd factor
    factor = mix64(np.arange(1, width + 1)) | np.uint64(1)
    total = np.zeros(len(h), np.uint64)
    for k in range(width):
        total[: len(h) - k] += h[k:] * factor[k]
    begin = np.repeat(off[:-1] - out_off[:-1], count) + np.arange(out_off[-1])
    value = total[begin]
    for i in np.flatnonzero((n > 0) & (n < width)).tolist():
        value[out_off[i]] = (h[off[i] : off[i + 1]] * factor[: n[i]]).sum(dtype=np.uint64) + np.uint64(n[i])
    return mix64(value), out_off


def least_overlap(n, percent: int):
    """Shared elements that a set of n elements needs with any set alike to it."""
    return (percent * n + 99) // 100


def count_vector(u: np.ndarray, groups: int) -> bytes:
    """Counts of the hashes by group, in the least of 1, 2 and 4 bytes each."""
    c = np.bincount((u & np.uint64(groups - 1)).astype(np.int64), minlength=groups)
    return c.astype("<u1" if c.max(initial=0) < 256 else "<u2" if c.max() < 65536 else "<u4").tobytes()


def vector(b: bytes, groups: int) -> np.ndarray:
    return np.frombuffer(b, {1: "<u1", 2: "<u2", 4: "<u4"}[len(b) // groups])


@cache
def levels(percent: int, top: int) -> tuple[list[int], list[int], list[int]]:
    """For rising numbers of differences, up to ``top``: the number itself, the empty groups allowed for, and all groups."""
    most, empty, groups = [], [], []
    d = 1
    while True:
        # the least set that can have over the last level's differences with a linked one
        least = ((most[-1] if most else 0) + 1) * percent / (100 - percent)
        e = 0
        for _ in range(20):
            k = d + 1 + e
            mean = k * np.exp(-least / k)
            e = int(np.ceil(mean + 2 * np.sqrt(mean) - 0.3))
        most.append(d)
        empty.append(e)
        groups.append(d + 1 + e)
        if d >= top:
            return most, empty, groups
        d = max(d + 1, d * 7 // 5)


def bucket_hashes(u: np.ndarray, percent: int, value: np.ndarray | None = None) -> np.ndarray:
    """The buckets of a set of sorted distinct hashes: linked, unequal sets have one in common."""
    n, out = len(u), []
    if n * (100 - percent) // percent < 1:
        return np.zeros(0, np.uint64)  # links with equal sets only
    value = mix64(u) if value is None else value
    least = value[: n - least_overlap(n, percent) + 1] + np.uint64(0x5851F42D4C957F2D)
    if percent < 70:  # most groups would be empty
        return least
    # differences that it can have with a linked set
    low, high = max(1, (100 - percent) * n // 100 - 2), (100 - percent) * n // percent
    most, empty, groups = levels(percent, 1 << int(high).bit_length())
    for i in range(int(np.searchsorted(most, low)), int(np.searchsorted(most, high)) + 1):
        k = groups[i]
        for salt in range(SALTS):
            g = ((u if not salt else mix64(u + np.uint64(salt))) % np.uint64(k)).astype(np.int64)
            total = np.zeros(k, np.uint64)
            np.add.at(total, g, value)
            full = np.flatnonzero(total)
            out.append(mix64(total[full] + full.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) + np.uint64((i * SALTS + salt + 1) << 40)))
            if k - len(full) <= empty[i]:
                break
        else:
            out.append(least)
    return np.concatenate(out)


def signatures(key: DataFrame, width: int, percent: int) -> DataFrame:
    """(id, node, n, buckets, vec, hash of the text); buckets and vec only for the first row of a node in a task."""
    kind = key.schema["id"].dataType.simpleString()
    key = key.select("id", "text", F.xxhash64("text").alias("hash"))

    def run(batches):
        seen: set[int] = set()
        for b in (x for whole in batches for x in parts(whole, size=SLICE)):
            h, off = shingle_hashes(b.column("text"), width)
            node, size, bucket, vec = [], [], [], []
            for a, z in zip(off[:-1].tolist(), off[1:].tolist(), strict=True):
                u = np.unique(h[a:z])
                value = mix64(u)
                k = node_of(value)
                node.append(k)
                size.append(len(u))
                if not len(u) or k in seen:
                    bucket.append(None)
                    vec.append(None)
                    continue
                seen.add(k)
                bucket.append(bucket_hashes(u, percent, value).view(np.int64))
                vec.append(count_vector(u, GROUPS))
            yield pa.RecordBatch.from_arrays([b.column("id"), pa.array(node, pa.int64()), pa.array(size, pa.int64()), pa.array(bucket, pa.list_(pa.int64())), pa.array(vec, pa.binary()), b.column("hash")], ["id", "node", "n", "buckets", "vec", "hash"])

    return key.mapInArrow(lean(run), f"id {kind}, node long, n long, buckets array<long>, vec binary, hash long")


def met_nodes(sig: DataFrame) -> DataFrame:
    """(sh, node, lead): the nodes of every bucket of two at least, and the least of them; a bucket streams through, however long."""
    rows = sig.where("buckets is not null").select(F.explode("buckets").alias("sh"), "node").repartition("sh").sortWithinPartitions("sh", "node")

    def run(batches):
        sh, node = np.zeros(0, np.int64), np.zeros(0, np.int64)
        lead = several = None  # of the bucket of the row that is held back

        def give(sh, node, lead, several, last):
            """The rows but the last one, unless it is the end; what the next call needs."""
            new = np.concatenate([[True], (sh[1:] != sh[:-1]) | (node[1:] != node[:-1])])
            sh, node = sh[new], node[new]
            same = sh[1:] == sh[:-1]
            keep = np.concatenate([[several], same]) | np.concatenate([same, [False]])
            start = np.concatenate([[0], np.flatnonzero(~same) + 1])
            first = node[start]
            first[0] = lead
            first = np.repeat(first, np.diff(np.append(start, len(sh))))
            end = len(sh) - (not last)
            out = [pa.array(x[:end][keep[:end]]) for x in (sh, node, first)]
            return pa.RecordBatch.from_arrays(out, ["sh", "node", "lead"]), sh[-1:], node[-1:], first[-1], keep[-1]

        for b in batches:
            if b.num_rows:
                more = [b.column(c).to_numpy() for c in ("sh", "node")]
                if lead is None:
                    lead, several = more[1][0], False
                batch, sh, node, lead, several = give(np.concatenate([sh, more[0]]), np.concatenate([node, more[1]]), lead, several, False)
                yield batch
        if len(sh):
            yield give(sh, node, lead, several, True)[0]

    return rows.mapInArrow(lean(run), "sh long, node long, lead long")


def leaders(rows: DataFrame) -> DataFrame:
    """(a, b): every node b of the rows (node, lead) with the leader a of most of its buckets."""
    often = rows.groupBy("node", "lead").agg(F.count("*").alias("n")).groupBy("node").agg(F.max(F.struct("n", "lead")).alias("at"))
    return often.select(F.col("at.lead").alias("a"), F.col("node").alias("b"))


def live_rows(rows: DataFrame, known: DataFrame, salt: int) -> DataFrame:
    """(sh, node, cls, lead, lead_cls) of the buckets (sh, node) that hold several classes; of buckets of the same nodes one."""
    named = rows.select("sh", "node").join(known, "node", "left").select("sh", "node", F.coalesce("root", "node").alias("cls"))
    order = F.struct(F.xxhash64("node", F.lit(salt)).alias("by"), "node", "cls")
    each = named.groupBy("sh").agg(F.min("cls").alias("x"), F.max("cls").alias("y"), F.min(order).alias("lead"), F.count("*").alias("size"), F.bit_xor(F.xxhash64("node")).alias("all"), F.sum(F.shiftright(F.xxhash64("node", F.lit(-1)), 24)).alias("sum"))
    each = each.where("x <> y").groupBy("size", "all", "sum", "lead").agg(F.min("sh").alias("sh"))
    return named.join(each.select("sh", "size", F.col("lead.node").alias("lead"), F.col("lead.cls").alias("lead_cls")), "sh")


def vectors(rows: list[bytes], groups: int) -> np.ndarray:
    same = {len(b) for b in rows}
    return vector(b"".join(rows), groups * len(rows)).reshape(-1, groups) if len(same) == 1 else np.stack([vector(b, groups) for b in rows])


def node_of(value: np.ndarray) -> int:
    """The name of a set of distinct hashes, each finalised once more; 0 for the empty set."""
    return int(mix64(value.sum(dtype=np.uint64, keepdims=True) + np.uint64(len(value)))[0].astype(np.int64)) if len(value) else 0


def bodies(key: DataFrame, sig: DataFrame, nodes: DataFrame) -> DataFrame:
    """(node, text) of the nodes, each once; a written table."""
    rows = sig.join(nodes, "node").groupBy("node", "id", "hash").agg((F.count("*") > 1).alias("many"))
    ids = materialise(rows.groupBy("node").agg(F.min(F.struct("many", "id", "hash")).alias("at")).select("node", F.col("at.id").alias("own"), "at.hash", "at.many"))
    key = key.withColumn("h", F.xxhash64("text"))
    few = ids.count() <= BROADCAST_NODES
    found = key.join(F.broadcast(ids) if few else ids, (key["h"] == ids["hash"]) & key["id"].eqNullSafe(ids["own"])).select("node", "text", "many")
    out = found.where("not many")
    if not ids.where("many").isEmpty():  # all rows of the node are repeated rows
        out = out.unionByName(found.where("many").dropDuplicates(["node"]))
    return materialise(out.drop("many"))


def bounded(pairs: DataFrame, points: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that the summed minima of the count vectors leave."""
    side = lambda c: points.select(F.col("node").alias(c), F.struct("n", "vec").alias(f"v{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").select("a", "b", F.col("va.n").alias("na"), F.col("vb.n").alias("nb"), F.col("va.vec").alias("x"), F.col("vb.vec").alias("y"))

    def run(batches):
        for b in batches:
            if b.num_rows:
                n, m = (b.column(c).to_numpy() for c in ("na", "nb"))
                reach = np.minimum(*(vectors(b.column(c).to_pylist(), GROUPS) for c in ("x", "y"))).sum(1, dtype=np.int64)
                ok = (reach * (100 + percent) >= percent * (n + m)) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m))
                yield pa.RecordBatch.from_arrays([b.column("a"), b.column("b")], ["a", "b"]).filter(pa.array(ok))

    return both.mapInArrow(lean(run), "a long, b long")


def verify(body: DataFrame, pairs: DataFrame, width: int, percent: int) -> DataFrame:
    """The pairs (a, b) whose shingle sets are alike, compared on the texts; each left side with at most STAR others in a task."""
    pairs = materialise(pairs)
    count = pairs.groupBy("a").count().select("a", F.ceil(F.col("count") / STAR).alias("parts"))
    member = pairs.join(count, "a").select("a", F.pmod(F.xxhash64("b"), F.col("parts")).alias("part"), F.col("b").alias("node"))
    leader = count.select("a", F.explode(F.sequence(F.lit(0).cast("long"), F.col("parts") - 1)).alias("part"), F.col("a").alias("node"))
    asked = member.unionByName(leader)
    few = pairs.count() <= BROADCAST_NODES // 2
    rows = body.join(F.broadcast(asked) if few else asked, "node").repartition("a", "part").sortWithinPartitions("a", "part", (F.col("node") != F.col("a")).cast("int"))

    def run(batches):
        lead, current = None, None
        for b in (x for whole in batches for x in parts(whole, size=SLICE)):
            h, off = shingle_hashes(b.column("text"), width)
            a, part, node = (b.column(c).to_numpy() for c in ("a", "part", "node"))
            links = []
            for i in range(b.num_rows):
                u = np.unique(h[off[i] : off[i + 1]])
                if node[i] == a[i]:
                    lead, current = (a[i], part[i]), u
                elif lead == (a[i], part[i]):
                    both = len(np.intersect1d(current, u, assume_unique=True))
                    if 100 * both >= percent * (len(u) + len(current) - both):
                        links.append((int(a[i]), int(node[i])))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in links], pa.int64()), pa.array([y for _, y in links], pa.int64())], ["a", "b"])

    return materialise(rows.select("a", "part", "node", "text").mapInArrow(lean(run), "a long, b long"))


def components(links: DataFrame, rounds: int = 60) -> DataFrame:
    """(node, root) of every node that has links: nodes move to their least neighbour and edges contract, until none is left."""
    edges, names = links.select("a", "b"), None
    for _ in range(rounds):
        both = edges.unionByName(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.first("a")).alias("to")).select(F.col("a").alias("node"), "to")
        step = materialise(least)
        hop = step.select(F.col("node").alias("to"), F.col("to").alias("to2"))
        step = materialise(step.join(hop, "to").select("node", F.col("to2").alias("root")))
        names = step if names is None else materialise(names.join(step.select(F.col("node").alias("root"), F.col("root").alias("r2")), "root", "left").select("node", F.coalesce("r2", "root").alias("root")))
        move = step.select(F.col("node").alias("a"), F.col("root").alias("x"))
        edges = edges.join(move, "a").join(move.select(F.col("a").alias("b"), F.col("x").alias("y")), "b").where("x <> y").select(F.col("x").alias("a"), F.col("y").alias("b")).distinct()
        edges = materialise(edges)
        if edges.isEmpty():
            return names
    raise RuntimeError("components: no end after all rounds")


class RTree:
    """Leaves of neighbouring points with the maxima and the sizes they span, split at the median of the widest coordinate."""

    def __init__(self, vec: np.ndarray, n: np.ndarray, cls: np.ndarray, early: np.ndarray | None = None):
        self.vec, self.n, self.cls, self.early = vec, n, cls, early  # early: the first buckets of each point
        self.leaves: list[np.ndarray] = []
        self._split(np.arange(len(n)))
        self.top = np.stack([vec[x].max(0) for x in self.leaves])
        self.low, self.high = (np.array([f(n[x]) for x in self.leaves]) for f in (np.min, np.max))
        self.only = np.array([cls[x[0]] if (cls[x] == cls[x[0]]).all() else 0 for x in self.leaves])

    def _split(self, at: np.ndarray) -> None:
        todo = [at]
        while todo:
            x = todo.pop()
            if len(x) <= LEAF:
                self.leaves.append(x)
                continue
            axis = self.vec[x].astype(np.float32).var(0).argmax()
            order = x[np.lexsort((x, self.vec[x, axis]))]
            todo += [order[: len(x) // 2], order[len(x) // 2 :]]

    def pairs(self, percent: int, other: RTree | None = None, sh: int = 0) -> tuple[np.ndarray, np.ndarray]:
        """Numbers of the pairs of different classes, within the tree or with another's, that the bound of their overlap leaves, without those that met in a bucket before ``sh``."""
        left, right, o = [], [], other or self
        for i, x in enumerate(self.leaves):
            j = 0 if other else i
            reach = np.minimum(self.top[i], o.top[j:]).sum(1, dtype=np.int64)
            need = percent * (self.low[i] + o.low[j:])
            ok = (reach * (100 + percent) >= need) & (100 * self.high[i] >= percent * o.low[j:]) & (100 * o.high[j:] >= percent * self.low[i])
            ok &= (self.only[i] == 0) | (o.only[j:] != self.only[i])
            for j in np.flatnonzero(ok) + j:
                y = o.leaves[j]
                shared = np.minimum(self.vec[x][:, None], o.vec[y][None]).sum(2, dtype=np.int64)
                n, m = self.n[x][:, None], o.n[y][None]
                good = (shared * (100 + percent) >= percent * (n + m)) & (100 * np.minimum(n, m) >= percent * np.maximum(n, m)) & (self.cls[x][:, None] != o.cls[y][None])
                if not other and i == j:
                    good &= np.arange(len(x))[:, None] < np.arange(len(y))[None]
                p, q = np.nonzero(good)
                p, q = x[p], y[q]
                for k in range(0, len(p), 1 << 14) if self.early is not None else ():
                    e, f = self.early[p[k : k + (1 << 14)]], o.early[q[k : k + (1 << 14)]]
                    new = ~((e[:, :, None] == f[:, None, :]) & (e < sh)[:, :, None]).any((1, 2))
                    left.append(p[k : k + (1 << 14)][new])
                    right.append(q[k : k + (1 << 14)][new])
                if self.early is None:
                    left.append(p)
                    right.append(q)
        return (np.concatenate(left), np.concatenate(right)) if left else (np.zeros(0, np.int64),) * 2


def _objects(values: list) -> np.ndarray:
    out = np.empty(len(values), object)
    out[:] = values
    return out


def first_buckets(early: list) -> np.ndarray:
    out = np.full((len(early), EARLY), np.iinfo(np.int64).max)
    for k, e in enumerate(early):
        out[k, : len(e)] = e
    return out


def bounds(p: np.ndarray, q: np.ndarray, n: np.ndarray, vec: np.ndarray) -> np.ndarray:
    """Of each pair of points the largest share of their sizes that their overlap can be."""
    out = np.zeros(len(p))
    for k in range(0, len(p), 1 << 14):
        x, y = p[k : k + (1 << 14)], q[k : k + (1 << 14)]
        out[k : k + (1 << 14)] = np.minimum(vectors(vec[x], GROUPS), vectors(vec[y], GROUPS)).sum(1, dtype=np.int64) / (n[x] + n[y])
    return out


def nearest(p: np.ndarray, q: np.ndarray, bound: np.ndarray, asks: np.ndarray, most: int) -> np.ndarray:
    """Which of the pairs (p, q) are among the ``most`` of the largest bound of a side that asks."""
    side, other, at = np.concatenate([p, q]), np.concatenate([q, p]), np.tile(np.arange(len(p)), 2)
    ok = asks[side]
    side, other, at = side[ok], other[ok], at[ok]
    order = np.lexsort((other, -bound[at], side))
    side = side[order]
    place = np.arange(len(side)) - np.searchsorted(side, side)
    return np.unique(at[order][place < most])


def rest_pairs(live: DataFrame, points: DataFrame, percent: int, most: int | None = None) -> DataFrame:
    """(a, b): pairs of different classes in one bucket that the R-tree's bounds leave; with ``most``, of each node only those of the largest bounds in its largest bucket. A bucket of over PART nodes goes to tasks as pairs of its parts."""
    if most is None:
        early = live.groupBy("node").agg(F.slice(F.sort_array(F.collect_list("sh")), 1, EARLY).alias("early"))
    else:
        early = live.groupBy("node").agg(F.array(F.max(F.struct("size", "sh"))["sh"]).alias("early"))
    points = points.join(early, "node")
    cut = F.ceil(F.col("size") / PART).cast("int")
    rows = live.select("sh", "node", "cls", cut.alias("cut"), F.pmod(F.xxhash64("node", F.lit("part")), cut).cast("int").alias("own"))
    rows = rows.select("sh", "node", "cls", "own", F.explode(F.sequence(F.lit(0), F.col("cut") - 1)).alias("with"))
    rows = rows.select("sh", F.least("own", "with").alias("x"), F.greatest("own", "with").alias("y"), "own", "node", "cls").join(points, "node")
    rows = rows.repartition("sh", "x", "y").sortWithinPartitions("sh", "x", "y", "own", "node")

    def run(batches):
        def of(sh, x, y, own, node, cls, n, vec, early):
            cuts = np.flatnonzero(np.concatenate([[True], (sh[1:] != sh[:-1]) | (x[1:] != x[:-1]) | (y[1:] != y[:-1]), [True]]))
            a, b = [], []
            for i, j in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
                m = i + int(np.searchsorted(own[i:j], x[i], "right")) if x[i] != y[i] else j
                trees = [RTree(vectors(vec[p:q], GROUPS), n[p:q], cls[p:q], first_buckets(early[p:q]) if most is None else None) for p, q in ((i, m), (m, j)) if q > p]
                if x[i] == y[i] or len(trees) == 2:
                    p, q = trees[0].pairs(percent, trees[1] if len(trees) == 2 else None, int(sh[i]))
                    p, q = p + i, q + (m if len(trees) == 2 else i)
                    if most is not None:
                        asks = np.array([e[0] == sh[i] for e in early[i:j]], bool)
                        few = nearest(p - i, q - i, bounds(p, q, n, vec), asks, most)
                        p, q = p[few], q[few]
                    a.append(node[p])
                    b.append(node[q])
            a, b = (np.concatenate(v) if v else np.zeros(0, np.int64) for v in (a, b))
            both = np.unique(np.stack([np.minimum(a, b), np.maximum(a, b)], 1), axis=0)
            return pa.RecordBatch.from_arrays([pa.array(both[:, 0]), pa.array(both[:, 1])], ["a", "b"])

        held = None
        for b in batches:
            if not b.num_rows:
                continue
            cols = [b.column(c).to_numpy() for c in ("sh", "x", "y", "own", "node", "cls", "n")] + [_objects(b.column(c).to_pylist()) for c in ("vec", "early")]
            if held is not None:
                cols = [np.concatenate([p, q]) for p, q in zip(held, cols, strict=True)]
            last = np.flatnonzero((cols[0] != cols[0][-1]) | (cols[1] != cols[1][-1]) | (cols[2] != cols[2][-1]))
            cut = int(last[-1]) + 1 if len(last) else 0
            if cut:
                yield of(*(p[:cut] for p in cols))
            held = [p[cut:] for p in cols]
        if held is not None:
            yield of(*held)

    return rows.mapInArrow(lean(run), "a long, b long").distinct()


def classes(key: DataFrame, width: int, percent: int, rounds: int | None = None) -> DataFrame:
    """(id, hash, n, cls) of each row of ``key`` (id, text): rows of equal cls are one component; cls is only a name."""
    rounds = rounds or ROUNDS
    sig = materialise(signatures(key, width, percent))
    met = materialise(met_nodes(sig))
    nodes = met.select("node").distinct()
    points = materialise(sig.where("vec is not null").join(nodes, "node").groupBy("node").agg(F.first("vec").alias("vec"), F.first("n").alias("n")))
    body = bodies(key, sig, points.select("node"))
    links = verify(body, bounded(leaders(met.where("node <> lead")), points, percent), width, percent)
    known, live = components(links), met
    for k in range(1, rounds + 1):
        live = materialise(live_rows(live, known, k))
        if live.isEmpty():
            break
        if k == rounds:
            pairs = rest_pairs(live, points, percent)
        elif k == 1:
            pairs = bounded(leaders(live.where("cls <> lead_cls")), points, percent)
        else:
            pairs = rest_pairs(live, points, percent, NEAR)
        more = verify(body, pairs, width, percent)
        if not more.isEmpty():
            links = links.unionByName(more)
            known = components(links)
    return sig.select("id", "hash", "node", "n").join(known, "node", "left").select("id", "hash", "n", F.coalesce("root", "node").alias("cls"))


def join(docs: DataFrame, width: int = 4, percent: int = 85, id_col: str = "doc_id") -> DataFrame:
    """Per document row: n_shingles, component_id, n_linked (rows of its component)."""
    prepare(docs.sparkSession)
    rows = classes(texts(docs, id_col), width, percent)
    least = rows.where("n > 0").groupBy("cls").agg(F.min("id").alias("least"), F.count("*").alias("n_linked"))
    rows = rows.join(least, "cls", "left")
    alone = F.col("n") == 0
    return rows.select(
        F.col("id").alias(id_col),
        F.col("n").alias("n_shingles"),
        F.when(alone, F.col("id")).otherwise(F.col("least")).alias("component_id"),
        F.when(alone, F.lit(1)).otherwise(F.col("n_linked")).cast("long").alias("n_linked"),
    )


def keep_one(docs: DataFrame, width: int = 5, percent: int = 80, id_col: str = "doc_id") -> DataFrame:
    """The documents with one of each component, that of the least id (then hash of the text); all columns kept.

    Documents without words are alone and stay. Rows of equal id and text are
    copies of each other, of which one stays.
    """
    prepare(docs.sparkSession)
    rows = materialise(classes(texts(docs, id_col), width, percent)).where("n > 0")
    first = rows.groupBy("cls").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "hash")).alias("at"))
    pairs = rows.groupBy("cls", "id", "hash").agg(F.count("*").alias("n")).join(first, "cls")
    own = F.col("at.id").eqNullSafe(F.col("id")) & (F.col("at.hash") == F.col("hash"))
    marks = materialise(pairs.select(F.col("id").alias("__id"), F.col("hash").alias("__hash"), own.alias("__own"), (F.col("n") > 1).alias("__many")).where("not __own or __many"))
    few = marks.count() <= BROADCAST_NODES
    hint = F.broadcast if few else (lambda df: df)
    named = docs.withColumn("__hash0", F.xxhash64(F.col("text").cast("string")))
    cond = (F.col("__hash0") == F.col("__hash")) & F.col(id_col).eqNullSafe(F.col("__id"))
    out = named.join(hint(marks), cond, "left")
    single = out.where(F.col("__hash").isNull()).select(*docs.columns)
    again = out.where(F.col("__own") & F.col("__many")).dropDuplicates(["__id", "__hash"]).select(*docs.columns)
    return single.unionByName(again)
