"""Exact Jaccard self-join on word n-grams, by signature trees, with connected components.

1. A scan finds frequent shingles; they go to the end of the order that prefixes are taken in.
2. A second scan gives each document its set's size, digest, prefix (two sets that link share a shingle of
   their prefixes) and a bitmap of its shingles, hashed to BITS bits.
   Documents with equal sets become one class, in an aggregation that combines before it shuffles.
3. Classes are sorted by their smallest shingles and cut into leaves of LEAF neighbours. Classes that agree
   on two smallest shingles are checked in small salted blocks, which joins most copies into components.
4. Each prefix shingle that two components share is a tree: leaves, and above them nodes that hold OR-combined
   bitmaps, size ranges and, if there is only one, the component. A dual traversal drops node pairs whose
   maximum possible overlap is too small for their sizes, or that hold one component only. Trees of more than
   SPLIT classes are dealt as pairs of blocks of leaves, so no task gets a crowded tree whole.
   What survives is a list of classes of two leaves, so a crowd of near copies is never written out as pairs.
5. Surviving leaf pairs are bounded again on bitmaps as long as the sets ask for, and then checked exactly on
   the whole sets. Components of all links follow.

The maximum possible overlap of two nodes is the least of: their largest sizes; the most shingles that follow
the tree's shingle in a set's order (a linked pair is found in the tree of its first common shingle); the bits
that both bitmaps have and the most shingles of a set that share a bit. Of two sets it is also a set's size
less the bits that it has and the other lacks. No bound ever drops a link; everything is exact but for
collisions of 64-bit hashes.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cantor.llm.common import Scratch, fresh, portions

WORDS, PERCENT = 4, 85
#: Classes of a leaf and of a block.
LEAF, BLOCK = 128, 96
#: Bits of the bitmap of all shingles.
BITS = 1024
#: Classes of a block of leaves, of which a tree with more of them is made.
SPLIT = 1024
#: Groups up to this size are one leaf pair each, and many are looked at together.
FLAT = 48
#: Pairs of smallest shingles whose agreement brings classes into a block (step 3).
HOMES = 3
#: Orders whose smallest shingles are taken.
BINS = 2 * HOMES
#: A shingle is frequent above FREQUENT prefixes, or more if over HOT_TOKENS shingles would be.
FREQUENT, HOT_TOKENS = 100, 1_000_000
#: Most class ids that are broadcast to pick documents; beyond it they are joined.
BROADCAST_IDS = 1_000_000
_LOWER = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))
_rng = np.random.default_rng(20240)
_MULTIPLY = _rng.integers(1, 1 << 31, BINS, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
_ADD = _rng.integers(0, 1 << 32, BINS, dtype=np.uint32)
_MIX = np.uint64(0xFF51AFD7ED558CCD)


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX
    return x ^ (x >> np.uint64(29))


def shingle_set(text: str, words: int = WORDS) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word n-grams; of all words together if there are fewer."""
    found = text.encode("utf-8", "surrogatepass").translate(_LOWER).split()
    if not found:
        return np.empty(0, np.uint64)
    h = np.fromiter(map(xxhash.xxh3_64_intdigest, found), np.uint64, len(found))
    width = min(words, len(h))
    out = np.full(len(h) - width + 1, width, np.uint64)
    for i in range(width):
        out = _mixed(out) + h[i : len(h) - width + 1 + i]
    return np.unique(_mixed(out))


def prefix_length(n: int, percent: int = PERCENT) -> int:
    """Shingles of a set of n of which a set that links with it has at least one."""
    return n + (-percent * n) // 100 + 1 if n else 0


def minima(tokens: np.ndarray) -> np.ndarray:
    """The smallest shingle's hash in each of BINS orders."""
    low = np.full(BINS, np.iinfo(np.uint32).max, np.uint32)
    short = (tokens >> np.uint64(7)).astype(np.uint32)
    for at in range(0, len(short), 512):
        x = short[at : at + 512, None] * _MULTIPLY + _ADD
        x ^= x >> np.uint32(15)
        low = np.minimum(low, (x * np.uint32(0x2C1B3C6D)).min(axis=0))
    return low


def signature(tokens: np.ndarray) -> bytes:
    """The bitmap of all shingles; bitmaps OR-combine."""
    bits = np.zeros(BITS, np.uint8)
    bits[tokens & np.uint64(BITS - 1)] = 1
    return np.packbits(bits).tobytes()


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))


def frequent_shingles(docs: DataFrame, percent: int, words: int) -> np.ndarray:
    """Sorted hashes of the shingles that stand in many documents' first two prefix lengths."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            sets = (shingle_set(t, words) for t in batch.column(0).to_pylist() if t)
            low = [u[: 2 * prefix_length(len(u), percent)] for u in sets]
            tokens, n = np.unique(np.concatenate([np.empty(0, np.uint64), *low]), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array(tokens.view(np.int64)), pa.array(n)], names=["token", "n"])

    counts = docs.select(F.col("text").cast("string")).mapInArrow(run, "token long, n long").groupBy("token").agg(F.sum("n").alias("n"))
    scratch = Scratch(docs.sparkSession, "frequent")
    counts = scratch.save(counts.filter(F.col("n") > FREQUENT), "counts")
    limit = FREQUENT
    while counts.filter(F.col("n") > limit).count() > HOT_TOKENS:
        limit *= 2
    hot = counts.filter(F.col("n") > limit).select("token").toArrow().column(0).to_numpy().view(np.uint64)
    scratch.drop("")
    return np.sort(hot)


def _is_in(tokens: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(tokens), bool)
    at = np.searchsorted(hot, tokens)
    return hot[np.minimum(at, len(hot) - 1)] == tokens


def ordered_prefix(tokens: np.ndarray, hot: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """The prefix in the order: shingles that aren't frequent by hash, then the frequent ones."""
    p = prefix_length(len(tokens), percent)
    first = tokens[: 2 * p]
    rare, crowded = first[~_is_in(first, hot)], tokens[:0]
    if len(rare) < p:
        flags = _is_in(tokens, hot)
        rare, crowded = tokens[~flags], tokens[flags]
    return rare[:p], crowded[: max(p - len(rare), 0)]


BASE = "doc_id long, n long, class long, prefix array<long>, crowded array<long>, signature binary, " + ", ".join(f"home{i} long" for i in range(HOMES))


def describe(docs: DataFrame, hot, percent: int, words: int) -> DataFrame:
    """Size, class (a digest of the set), prefix, signature and homes of each document's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                u = shingle_set(text or "", words)
                low = minima(u)
                homes = [xxhash.xxh64_intdigest(low[2 * i : 2 * i + 2].tobytes()) for i in range(HOMES)]
                digest = xxhash.xxh3_64_intdigest(u.tobytes())
                rare, crowded = ordered_prefix(u, hot.value, percent)
                rows.append((doc_id, len(u), digest, rare.view(np.int64), crowded.view(np.int64), signature(u), *homes))
            cols = list(zip(*rows, strict=True)) or [()] * (6 + HOMES)
            signed = lambda c: pa.array(np.asarray(c, np.uint64).view(np.int64))
            arrays = [pa.array(cols[0], pa.int64()), pa.array(cols[1], pa.int64()), signed(cols[2]), *(pa.array(c, pa.list_(pa.int64())) for c in cols[3:5]), pa.array(cols[5], pa.binary()), *map(signed, cols[6:])]
            yield pa.RecordBatch.from_arrays(arrays, names=[x.split()[0] for x in BASE.split(", ")])

    return _texts(docs).mapInArrow(run, BASE)


def long_bitmap(tokens: np.ndarray) -> bytes:
    """A bitmap of at least four bits a shingle; its halves OR-combine to the bitmap of half the length."""
    length = max(BITS, 1 << max(4 * len(tokens) - 1, 0).bit_length())
    bits = np.zeros(length, np.uint8)
    bits[tokens & np.uint64(length - 1)] = 1
    return np.packbits(bits).tobytes()


def class_sets(docs: DataFrame, wanted: DataFrame, words: int, scratch: Scratch, name: str) -> DataFrame:
    """(class, tokens, bitmap) of the wanted classes (class, rep), from the texts of their representatives."""
    wanted = scratch.save(wanted, f"{name}-wanted")
    side = F.broadcast(wanted) if wanted.count() <= BROADCAST_IDS else wanted
    rows = _texts(docs).join(side, F.col("doc_id") == F.col("rep")).select("class", "text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in portions(batches):
            kept = []
            for number, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                tokens = shingle_set(text or "", words)
                data = tokens.tobytes()
                if int(np.uint64(xxhash.xxh3_64_intdigest(data)).view(np.int64)) == number:
                    kept.append((number, data, long_bitmap(tokens)))
            kinds = (pa.int64(), pa.binary(), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([k[i] for k in kept], kind) for i, kind in enumerate(kinds)], names=["class", "tokens", "bitmap"])

    # one row of each representative, whose repeated rows would be written again and again
    return scratch.save(rows.mapInArrow(run, "class long, tokens binary, bitmap binary").dropDuplicates(["class"]), name)


def _folded(bitmaps: list[np.ndarray], length: int) -> np.ndarray:
    out = []
    for x in bitmaps:
        while len(x) > length:
            x = x[: len(x) // 2] | x[len(x) // 2 :]
        out.append(x)
    return np.stack(out)


def bounded(units: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The rows of ``units`` (unit, class, side, comp, n) that have a partner of possible overlap by the long bitmaps."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            side, comp, size = (group.column(i).to_numpy(zero_copy_only=False) for i in (2, 3, 4))
            bitmaps = [np.frombuffer(x, np.uint64) for x in group.column(5).to_pylist()]
            keep = np.zeros(len(side), bool)
            cols = np.flatnonzero(side & 2)
            for i in np.flatnonzero(side & 1):
                need = -(-percent * (size[i] + size[cols]) // (100 + percent))
                which = (np.minimum(size[i], size[cols]) >= need) & (comp[i] != comp[cols])
                some, need = cols[which], need[which]
                if not len(some):
                    continue
                length = min(len(bitmaps[i]), *(len(bitmaps[j]) for j in some)) if len(some) else 0
                own, others = _folded([bitmaps[i]], length)[0], _folded([bitmaps[j] for j in some], length)
                slack = np.minimum(size[i] - int(np.bitwise_count(own).sum()), size[some] - np.bitwise_count(others).sum(axis=1, dtype=np.int64))
                good = np.bitwise_count(own & others).sum(axis=1, dtype=np.int64) + slack >= need
                keep[some[good]] = True
                keep[i] |= good.any()
            if keep.any():
                yield pa.RecordBatch.from_arrays([c.filter(pa.array(keep)) for c in group.columns[:4]], names=["unit", "class", "side", "comp"])

    rows = units.join(sets.select("class", "bitmap"), "class").select("unit", "class", "side", "comp", "n", "bitmap")
    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "unit long, class long, side int, comp long")


def overlaps(left: list[np.ndarray], right: list[np.ndarray]) -> np.ndarray:
    """Intersection sizes of all pairs: by search for a few, else by products of incidence blocks."""
    if len(left) * len(right) <= 16:
        return np.array([[len(np.intersect1d(a, b, assume_unique=True)) for b in right] for a in left])
    at = [np.repeat(np.arange(len(side)), [len(s) for s in side]) for side in (left, right)]
    flat = [np.concatenate(side) for side in (left, right)]
    both = np.intersect1d(*flat)
    out = np.zeros((len(left), len(right)), np.float32)
    column = [np.searchsorted(both, f) for f in flat]
    hit = [(c < len(both)) & (both[np.minimum(c, len(both) - 1)] == f) if len(both) else np.zeros(len(f), bool) for c, f in zip(column, flat, strict=True)]
    for start in range(0, len(both), 8192):
        blocks = []
        for side, c, h, rows in zip((left, right), column, hit, at, strict=True):
            block = np.zeros((len(side), min(8192, len(both) - start)), np.float32)
            use = h & (c >= start) & (c < start + 8192)
            block[rows[use], c[use] - start] = 1
            blocks.append(block)
        out += blocks[0] @ blocks[1].T
    return out.astype(np.int64)


class _Forest:
    """Union-find over a unit's classes, to return links that span its components."""

    def __init__(self) -> None:
        self.up: dict[int, int] = {}

    def find(self, x: int) -> int:
        while self.up.setdefault(x, x) != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, a: int, b: int) -> bool:
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)
        return a != b


def _groups(batches: Iterator[pa.RecordBatch], key: int = 0) -> Iterator[pa.RecordBatch]:
    """Rows of one key at a time, from batches sorted by it."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = batch.column(key).to_numpy(zero_copy_only=False)
        cuts = [0, *(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]
        for lo, hi in zip(cuts, cuts[1:], strict=False):
            if held and held[-1].column(key)[0].as_py() != keys[lo]:
                yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]
                held = []
            held.append(batch.slice(lo, hi - lo))
    if held:
        yield pa.Table.from_batches(held).combine_chunks().to_batches()[0]


def verify(units: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Links (a, b) that span what is linked between the sides of each unit (unit, class, side, comp).

    A unit has at most a few hundred classes; sides are bits (1, 2, or 3 for both). Pairs of one component
    are not looked at again.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches):
            number, side, comp = (group.column(i).to_numpy(zero_copy_only=False) for i in (1, 2, 3))
            tokens = [np.frombuffer(x, np.uint64) for x in group.column(4).to_pylist()]
            size = np.array([len(x) for x in tokens])
            rows, cols = np.flatnonzero(side & 1), np.flatnonzero(side & 2)
            if not len(rows) or not len(cols):
                continue
            both = overlaps([tokens[i] for i in rows], [tokens[i] for i in cols])
            link = (100 * both >= percent * (size[rows][:, None] + size[cols][None, :] - both)) & (number[rows][:, None] != number[cols][None, :])
            forest, out = _Forest(), []
            for c in np.unique(comp):
                same = number[comp == c].tolist()
                for x in same[1:]:
                    forest.join(same[0], x)
            for i, j in zip(*np.nonzero(link), strict=True):
                a, b = int(number[rows[i]]), int(number[cols[j]])
                if forest.join(a, b):
                    out.append((a, b))
            if out:
                yield pa.RecordBatch.from_arrays([pa.array([o[k] for o in out], pa.int64()) for k in (0, 1)], names=["a", "b"])

    rows = units.join(sets, "class").select("unit", "class", "side", "comp", "tokens")
    return rows.repartition("unit").sortWithinPartitions("unit").mapInArrow(run, "a long, b long")


def components(edges: DataFrame, scratch: Scratch, name: str) -> DataFrame:
    """(node, comp) for the nodes of ``edges`` (a, b): the smallest node that each can reach.

    Each round hooks every node to its smallest neighbour, shortens the hooks, and contracts the graph; only
    links between different contracted nodes go on, so the rounds grow with the logarithm of the nodes.
    """
    pairs = edges.filter("a <> b")
    graph = scratch.save(pairs.union(pairs.select(F.col("b").alias("a"), F.col("a").alias("b"))).distinct(), f"{name}-graph0")
    labels = scratch.save(graph.select(F.col("a").alias("node")).distinct().withColumn("comp", F.col("node")), f"{name}-labels0")
    turn = 0
    while graph.limit(1).count():
        turn += 1
        hooks = scratch.save(graph.groupBy("a").agg(F.min("b").alias("b")).select("a", F.least("a", "b").alias("up")), f"{name}-hooks{turn}")
        for jump in range(3):
            above = hooks.select(F.col("a").alias("up"), F.col("up").alias("top"))
            hooks = hooks.join(above, "up", "left").select("a", F.coalesce("top", "up").alias("up"))
        hooks = scratch.save(hooks, f"{name}-hooked{turn}")
        moved = hooks.select(F.col("a").alias("comp"), F.col("up").alias("next"))
        labels = scratch.save(labels.join(moved, "comp", "left").select("node", F.coalesce("next", "comp").alias("comp")), f"{name}-labels{turn}")
        left = graph.join(hooks, "a").select(F.col("up").alias("x"), F.col("b").alias("a"))
        graph = scratch.save(left.join(hooks, "a").select(F.col("x").alias("a"), F.col("up").alias("b")).filter("a <> b").distinct(), f"{name}-graph{turn}")
        scratch.drop(f"{name}-graph{turn - 1}", f"{name}-labels{turn - 1}", f"{name}-hooks{turn}", f"{name}-hooked{turn}")
    return labels


class _Group:
    """Classes of one tree, sorted by leaf: columns of equal length.

    rest: shingles from the tree's shingle on in the set's order. slack: shingles less bits of the bitmap.
    """

    __slots__ = ("number", "size", "comp", "leaf", "rest", "slack", "bits")

    def __init__(self, number, size, comp, leaf, rest, bits, slack=None):
        self.number, self.size, self.comp, self.leaf, self.rest, self.bits = number, size, comp, leaf, rest, bits
        self.slack = size - np.bitwise_count(bits).sum(axis=1, dtype=np.int64) if slack is None else slack

    def cut(self, at) -> _Group:
        return _Group(self.number[at], self.size[at], self.comp[at], self.leaf[at], self.rest[at], self.bits[at], self.slack[at])


class _Node:
    """Members lo..hi of a group: OR-combined bitmap, ranges, the component if there is one only."""

    __slots__ = ("lo", "hi", "bits", "small", "large", "rest", "slack", "comp", "parts")

    def __init__(self, lo, hi, bits, small, large, rest, slack, comp, parts=()):
        self.lo, self.hi, self.bits, self.small, self.large, self.rest, self.slack, self.comp, self.parts = lo, hi, bits, small, large, rest, slack, comp, parts

    def may_link(self, other: _Node, percent: int) -> bool:
        """Whether the maximum possible overlap is enough for the smallest sizes."""
        if self.comp is not None and self.comp == other.comp:
            return False
        need = percent * max(self.small + max(other.small, -(-percent * self.small // 100)), other.small + max(self.small, -(-percent * other.small // 100)))
        if (100 + percent) * min(self.large, other.large, self.rest, other.rest) < need:
            return False
        return (100 + percent) * (int(np.bitwise_count(self.bits & other.bits).sum()) + min(self.slack, other.slack)) >= need


def _tree(group: _Group) -> _Node:
    cuts = [0, *(np.flatnonzero(np.diff(group.leaf)) + 1).tolist(), len(group.leaf)]
    level = []
    for lo, hi in zip(cuts, cuts[1:], strict=False):
        one = int(group.comp[lo]) if (group.comp[lo:hi] == group.comp[lo]).all() else None
        size = group.size[lo:hi]
        level.append(_Node(lo, hi, np.bitwise_or.reduce(group.bits[lo:hi], axis=0), int(size.min()), int(size.max()), int(group.rest[lo:hi].max()), int(group.slack[lo:hi].max()), one))
    while len(level) > 1:
        above = []
        for i in range(0, len(level), 4):
            parts = level[i : i + 4]
            one = parts[0].comp if all(p.comp is not None and p.comp == parts[0].comp for p in parts) else None
            bits = np.bitwise_or.reduce([p.bits for p in parts], axis=0)
            above.append(_Node(parts[0].lo, parts[-1].hi, bits, min(p.small for p in parts), max(p.large for p in parts), max(p.rest for p in parts), max(p.slack for p in parts), one, tuple(parts)))
        level = above
    return level[0]


def may_link(a: _Group, i: np.ndarray, b: _Group, j: np.ndarray, percent: int) -> np.ndarray:
    """Which of the pairs (i of a, j of b) components and the maximum possible overlap leave possible."""
    need = -(-percent * (a.size[i] + b.size[j]) // (100 + percent))
    ok = (np.minimum(np.minimum(a.rest[i], b.rest[j]), np.minimum(a.size[i], b.size[j])) >= need) & (a.comp[i] != b.comp[j])
    at = np.flatnonzero(ok)
    for lo in range(0, len(at), 50_000):
        part = at[lo : lo + 50_000]
        x, y = a.bits[i[part]], b.bits[j[part]]
        n, m = a.size[i[part]], b.size[j[part]]
        both = np.bitwise_count(x & y).sum(axis=1, dtype=np.int64)
        # of a set's bits, those that the other lacks are at least so many shingles that the other lacks
        ok[part] = both + np.minimum(a.slack[i[part]], b.slack[j[part]]) >= need[part]
    return ok


def traverse(a: _Group, b: _Group | None = None, percent: int = PERCENT) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Dual traversal of signature trees: (rows of a, rows of b) that may link; of one tree with itself without b."""
    root = _tree(a)
    todo = [(root, root if b is None else _tree(b))]
    b = a if b is None else b
    while todo:
        x, y = todo.pop()
        if not x.may_link(y, percent):
            continue
        if x.parts or y.parts:
            if x is y:
                todo += combinations(x.parts, 2)
                todo += [(p, p) for p in x.parts]
            elif x.parts and (not y.parts or x.hi - x.lo >= y.hi - y.lo):
                todo += [(p, y) for p in x.parts]
            else:
                todo += [(x, p) for p in y.parts]
            continue
        i, j = (z.ravel() for z in np.meshgrid(np.arange(x.lo, x.hi), np.arange(y.lo, y.hi), indexing="ij"))
        if x is y:
            i, j = i[i < j], j[i < j]
        good = may_link(a, i, b, j, percent)
        if good.any():
            yield np.unique(i[good]), np.unique(j[good])


def tree_members(classes: DataFrame, scratch: Scratch) -> DataFrame:
    """(token, class, rest, m): the classes of each prefix shingle that two components share, m in all.

    Shingles that aren't frequent have few classes each, which a window sees; frequent ones are counted first
    and then joined.
    """

    def postings(array: str, before) -> DataFrame:
        rows = classes.select("class", "comp", (F.col("n") - before).alias("rest"), F.posexplode(array).alias("at", "token"))
        return rows.select("token", "class", "comp", (F.col("rest") - F.col("at")).alias("rest"))

    tree = Window.partitionBy("token")
    rare = postings("prefix", F.lit(0)).withColumn("low", F.min("comp").over(tree)).withColumn("high", F.max("comp").over(tree)).withColumn("m", F.count("*").over(tree))
    rare = rare.filter("low <> high").select("token", "class", "rest", "m")
    crowded = postings("crowded", F.size("prefix"))
    trees = crowded.groupBy("token").agg(F.min("comp").alias("low"), F.max("comp").alias("high"), F.count("*").alias("m")).filter("low <> high").select("token", "m")
    # written, so that the join deals both sides anew and a crowded tree can be split
    trees = scratch.save(trees, "trees")
    return rare.union(crowded.select("token", "class", "rest").join(trees, "token").select("token", "class", "rest", "m"))


UNITS = "la long, lb long, class long, side int"


def candidate_leaves(members: DataFrame, classes: DataFrame, percent: int) -> DataFrame:
    """(la, lb, class, side): classes of two leaves between which a link is possible, from every tree.

    A tree of more than SPLIT classes is dealt as pairs of its blocks, which are sets of leaves.
    """
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.int32()]

    def units(tree: np.ndarray, side: np.ndarray, group: _Group) -> list[np.ndarray]:
        out = []

        def add(rows: np.ndarray, other: _Group, cols: np.ndarray, of: _Group) -> None:
            la, lb = of.leaf[rows[0]], other.leaf[cols[0]]
            flip = la > lb
            for number, one in ((of.number[rows], 2 if flip else 1), (other.number[cols], 1 if flip else 2)):
                out.append(np.stack([np.full(len(number), min(la, lb)), np.full(len(number), max(la, lb)), number, np.full(len(number), one)]))

        edges = np.flatnonzero(np.diff(tree)) + 1
        starts, ends = np.concatenate([[0], edges]), np.concatenate([edges, [len(tree)]])
        alone = (ends - starts > FLAT) | (side[starts] != 3)
        for lo, hi in zip(starts[alone], ends[alone], strict=True):
            if side[lo] == 3:
                one = group.cut(slice(lo, hi))
                for rows, cols in traverse(one, percent=percent):
                    add(rows, one, cols, one)
            elif side[hi - 1] != side[lo]:
                mid = lo + int(np.searchsorted(side[lo:hi], 2))
                one, two = group.cut(slice(lo, mid)), group.cut(slice(mid, hi))
                for rows, cols in traverse(one, two, percent):
                    add(rows, two, cols, one)
        end = np.repeat(np.where(alone, starts, ends), ends - starts)
        at = np.arange(len(tree))
        for step in range(1, FLAT):
            i = at[at + step < end]
            if not len(i):
                break
            good = i[may_link(group, i, group, i + step, percent)]
            la, lb = group.leaf[good], group.leaf[good + step]
            for number in (good, good + step):
                out.append(np.stack([la, lb, group.number[number], np.full(len(good), 1 if number is good else 2)]))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[list[np.ndarray]] = []

        def found() -> Iterator[pa.RecordBatch]:
            tree, side, *columns = (np.concatenate(c) for c in zip(*held, strict=True))
            rows = units(tree, side, _Group(*columns)) if len(tree) else []
            if rows:
                table = np.unique(np.concatenate(rows, axis=1), axis=1)
                for lo in range(0, table.shape[1], 100_000):
                    yield pa.RecordBatch.from_arrays([pa.array(c[lo : lo + 100_000], k) for c, k in zip(table, kinds, strict=True)], names=["la", "lb", "class", "side"])

        for batch in batches:
            if not batch.num_rows:
                continue
            plain = [c.to_numpy(zero_copy_only=False) for c in batch.columns[:7]]
            bits = np.frombuffer(b"".join(batch.column(7).to_pylist()), np.uint64).reshape(len(plain[0]), -1)
            columns = [*plain, bits]
            tree = plain[0]
            other = np.flatnonzero(tree != tree[-1])
            last = int(other[-1]) + 1 if len(other) else 0
            if held and not last and held[-1][0][-1] == tree[0]:
                held.append(columns)
                continue
            held.append([c[:last] for c in columns])
            yield from found()
            held = [[c[last:] for c in columns]]
        if held:
            yield from found()

    blocks = F.ceil(F.col("m") / SPLIT).cast("int")
    own = F.pmod(F.xxhash64("leaf"), blocks).cast("int")
    rows = members.join(classes.select("class", "n", "comp", "leaf", "signature"), "class").withColumn("own", own)
    one = rows.filter(F.col("m") <= SPLIT).select(F.col("token").alias("tree"), F.lit(3).alias("side"), "class", "n", "comp", "leaf", "rest", "signature")
    pair = rows.filter(F.col("m") > SPLIT).withColumn("other", F.explode(F.sequence(F.lit(0), blocks - 1)))
    side = F.when(F.col("own") == F.col("other"), 3).when(F.col("own") < F.col("other"), 1).otherwise(2)
    several = pair.select(F.xxhash64("token", F.least("own", "other"), F.greatest("own", "other")).alias("tree"), side.alias("side"), "class", "n", "comp", "leaf", "rest", "signature")
    return one.union(several).repartition("tree").sortWithinPartitions("tree", "side", "leaf", "class").mapInArrow(run, UNITS)


def ngram_jaccard_join(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """(doc_id, n_shingles, component_id) of each row of ``docs`` (doc_id, text).

    Documents link when 100 * intersection >= percent * union of their sets of word n-grams. A component is
    named by its smallest doc_id. Null and empty texts, and texts of blanks, have empty sets and link with
    nothing; rows without a doc_id link with nothing and have no component. Repeated rows are returned as
    often as they come. Further columns are ignored.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "jaccard")
    hot = spark.sparkContext.broadcast(frequent_shingles(docs, percent, words))
    base = scratch.save(describe(docs, hot, percent, words), "base")
    firsts = [F.first(c).alias(c) for c in ("n", "prefix", "crowded", "signature", *(f"home{i}" for i in range(HOMES)))]
    classes = base.filter("n > 0 and doc_id is not null").groupBy("class").agg(F.min("doc_id").alias("rep"), *firsts)
    order = ["home0", "n", "class"]
    classes = classes.repartitionByRange(*order).sortWithinPartitions(*order).withColumn("leaf", F.shiftright(F.monotonically_increasing_id(), LEAF.bit_length() - 1))
    classes = scratch.save(classes, "classes")
    rows = scratch.save(base.select("doc_id", F.col("n").alias("n_shingles"), F.when((F.col("n") > 0) & F.col("doc_id").isNotNull(), F.col("class")).alias("class")), "rows")
    scratch.drop("base")

    homes = classes.select("class", "rep", F.posexplode(F.array(*[f"home{i}" for i in range(HOMES)])).alias("i", "home"))
    # written, so that the join deals both sides anew and a crowded home can be split
    crowd = scratch.save(homes.groupBy("i", "home").agg(F.count("*").alias("m")).filter("m > 1"), "crowd")
    salt = F.pmod(F.xxhash64("class", "i"), F.ceil(F.col("m") / BLOCK))
    blocks = homes.join(crowd, ["i", "home"]).select(F.xxhash64("i", "home", salt).alias("unit"), "class", F.lit(3).alias("side"), F.col("class").alias("comp"), "rep")
    blocks = scratch.save(blocks, "blocks")
    near = class_sets(docs, blocks.select("class", "rep").distinct(), words, scratch, "near-sets")
    links = scratch.save(verify(blocks.drop("rep"), near, percent), "links0")
    first = components(links, scratch, "first")
    classes = scratch.save(classes.join(first.withColumnRenamed("node", "class"), "class", "left").withColumn("comp", F.coalesce("comp", "class")), "joined")
    scratch.drop("classes", "crowd", "blocks", "near-sets")

    shared = scratch.save(tree_members(classes, scratch), "shared")
    found = candidate_leaves(shared, classes, percent)
    units = found.groupBy(F.xxhash64("la", "lb").alias("unit"), "class").agg(F.bit_or("side").alias("side")).join(classes.select("class", "comp", "rep", "n"), "class")
    units = scratch.save(units, "units")
    scratch.drop("shared")
    rest = class_sets(docs, units.select("class", "rep").distinct(), words, scratch, "rest-sets")
    more = verify(scratch.save(bounded(units.select("unit", "class", "side", "comp", "n"), rest, percent), "bounded"), rest, percent)
    links = scratch.save(links.union(more), "links1")
    final = components(links, scratch, "final")
    named = classes.select("class", "rep").join(final.withColumnRenamed("node", "class"), "class", "left").withColumn("comp", F.coalesce("comp", "class"))
    names = named.groupBy("comp").agg(F.min("rep").alias("component_id"))
    named = scratch.save(named.join(names, "comp").select("class", "component_id"), "named")
    scratch.drop("joined", "trees", "units", "bounded", "rest-sets", "links0", "links1")
    return rows.join(named, "class", "left").select("doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))


def keep_one_of_each(docs: DataFrame, percent: int = PERCENT, words: int = WORDS) -> DataFrame:
    """The documents that name their component: one of each group of near copies, and all that link with nothing.

    Rows of one doc_id are one document and stay together, but for rows that repeat id and text, of which one
    stays; rows without a doc_id stay.
    """
    ids, named, times = fresh(docs, "named"), fresh(docs, "id"), fresh(docs, "times")
    linked = ngram_jaccard_join(docs, percent, words).groupBy(F.col("doc_id").alias(named)).agg(F.count("*").alias(times), F.bool_or(F.col("doc_id") == F.col("component_id")).alias(ids)).filter(f"{ids} and {named} is not null").drop(ids)
    kept = docs.join(linked, F.col("doc_id") == F.col(named))
    once = kept.filter(F.col(times) == 1).select(docs.columns)
    repeated = kept.filter(F.col(times) > 1).select(docs.columns).dropDuplicates(["doc_id", "text"])
    return once.union(repeated).union(docs.filter("doc_id is null"))
