"""Jaccard join of shingle sets: exact partitions of the candidates, and a signature tree in each.

1. Sets that link differ in a bounded number of shingles.  The hash range is cut into more slices than
   that bound, so linked sets agree on whole slices; hashes of slices are keys.  Sets that share a
   key, directly or through others, form a partition.  No linked pair is lost, and each set is in one.
2. In a partition, sets are the leaves of a signature tree: each node holds the OR of the bitmaps below
   and the range of set sizes.  A dual traversal from the roots drops node pairs whose largest possible
   overlap cannot reach the threshold, and node pairs already known to be one component.
3. Passages that many texts share chain unrelated sets to partitions that grow with the table.  In a large one only
   the sets of one key are compared, with bitmaps alone first, which splits it into finer ones; then, with the
   sets, pairs that reach the leaves are compared exactly, and those that link are edges of the components.
"""

from __future__ import annotations

import functools
import hashlib
import itertools
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelift.llm.common import stored
from pricelift.llm.components import connected_components

#: Keys a task combines at a time.
KEY_BUFFER = 400_000
#: Ranges of keys to a shuffle partition, at least; beyond that they follow the number of documents.
RANGES = 4
DOCS_TO_RANGE = 10_000
#: Sets and shingles to a cell of a partition; larger partitions are compared cell against cell.
CELL_SETS = 1024
CELL_SHINGLES = 2_000_000
#: Children to a tree node.
FAN = 8

_A, _B, _C = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xBF58476D1CE4E5B9), np.uint64(0x94D049BB133111EB)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit (the splitmix64 finaliser)."""
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * _B
        x = (x ^ (x >> np.uint64(27))) * _C
        return x ^ (x >> np.uint64(31))


def shingle_set(text: str | None, size: int) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the word shingles of a text.

    Words are runs of anything but ASCII white space, with A-Z lower-cased.  Fewer words than ``size``
    are one shingle together; no words give the empty set.
    """
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return np.empty(0, np.uint64)
    hashes = np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))
    width = min(size, len(words))
    places = len(words) - width + 1
    folded = np.full(places, width, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(width):
            folded = mix(folded * _A + hashes[k : k + places])
    return np.unique(folded)


def links(overlap, a, b, percent: int):
    return 100 * overlap >= percent * (a + b - overlap)


class Slices:
    """How sets of a size are cut into slices, for a threshold in percent.

    Sizes fall into levels so wide that linked sets are on the same level or on neighbouring ones;
    a pair meets on the level of its larger set.  On a level with at most D differences:
    D = 0: one slice.  D <= 6: D + 2 slices, keys are pairs of slices.  Beyond: D and some spare slices, keys
    are single slices; as linked sets agree on at least the spare number of slices, a set with fewer
    small slices than that can leave its small ones out, and rare other sets keep all of theirs.
    """

    def __init__(self, percent: int):
        if not 50 <= percent <= 100:
            raise ValueError("a threshold between 50 and 100 percent is needed")
        self.percent = percent
        self.starts = [1]

    def level(self, n: int) -> int:
        while self.starts[-1] <= n:
            self.starts.append(100 * self.starts[-1] // self.percent + 1)
        return int(np.searchsorted(self.starts, n, side="right")) - 1

    @functools.lru_cache(maxsize=4096)  # noqa: B019
    def plan(self, level: int) -> tuple[np.ndarray, int, int, np.ndarray, np.ndarray]:
        """Slice edges, spare slices, size of small slices, and the salts or slice pairs of keys."""
        self.level(self.starts[-1])
        while len(self.starts) <= level + 1:
            self.level(self.starts[-1])
        most = self.starts[level + 1] - 1
        differ = (100 - self.percent) * 2 * most // (100 + self.percent)
        if differ == 0:
            slices, spare = 1, 1
        elif differ <= 6:
            slices, spare = differ + 2, 2
        else:
            spare = 4 + differ // 8
            slices = differ + spare
        small = 1 if self.starts[level] >= 6 * slices else 0
        # slice i holds hashes in [i * 2^64 / slices, (i + 1) * 2^64 / slices)
        edges = np.array([(i << 64) // slices for i in range(1, slices)], dtype=np.uint64)
        salts = mix(np.arange(1, slices + 1, dtype=np.uint64) + np.uint64((level + 1) << 32))
        pairs = np.array(list(itertools.combinations(range(slices), 2)), dtype=np.int64).reshape(-1, 2) if 0 < differ <= 6 else np.empty((0, 2), np.int64)
        return edges, spare, small, salts, pairs

    def keys(self, hashes: np.ndarray) -> np.ndarray:
        n = len(hashes)
        if n == 0:
            return np.empty(0, np.uint64)
        level = self.level(n)
        levels = [level]
        if 100 * n // self.percent >= self.starts[level + 1]:
            levels.append(level + 1)
        with np.errstate(over="ignore"):
            sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(mix(hashes ^ _A), dtype=np.uint64)])
            return np.concatenate([self._on(hashes, sums, one) for one in levels])

    def _on(self, hashes: np.ndarray, sums: np.ndarray, level: int) -> np.ndarray:
        edges, spare, small, salts, pairs = self.plan(level)
        cuts = np.concatenate([[0], np.searchsorted(hashes, edges), [len(hashes)]])
        each = mix((sums[cuts[1:]] - sums[cuts[:-1]]) ^ salts)
        if len(pairs):
            return mix(each[pairs[:, 0]] * _A + each[pairs[:, 1]])
        if len(each) == 1:
            return each
        large = np.diff(cuts) > small
        return each[large] if len(each) - large.sum() < spare else each


ROWS = pa.schema([("p", pa.int32()), ("a", pa.int64()), ("b", pa.int64()), ("c", pa.int64()), ("d", pa.int64()), ("keys", pa.binary()), ("nodes", pa.binary()), ("mark", pa.binary())])
ROWS_DDL = "p int, a long, b long, c long, d long, keys binary, nodes binary, mark binary"


def _rows(p=None, a=None, b=None, c=None, d=None, keys=None, nodes=None, mark=None) -> pa.RecordBatch:
    columns = (p, a, b, c, d, keys, nodes, mark)
    n = next(len(x) for x in columns if x is not None)
    return pa.RecordBatch.from_arrays([pa.nulls(n, f.type) if x is None else pa.array(x, f.type) for x, f in zip(columns, ROWS, strict=True)], schema=ROWS)


def planes(values: np.ndarray) -> bytes:
    """64-bit integers byte plane by byte plane: high bytes that hardly change then compress to nothing."""
    return values.view(np.uint8).reshape(-1, 8).T.tobytes()


def from_planes(data: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(data, np.uint8).reshape(8, -1).T).view(np.uint64).ravel()


def _firsts(key: np.ndarray, node: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct keys with their smallest nodes, and edges (other node, that one, key) from the other nodes of a key."""
    order = np.lexsort((node, key))
    key, node = key[order], node[order]
    new = np.concatenate([[True], key[1:] != key[:-1]])
    first = node[np.flatnonzero(new)[np.cumsum(new) - 1]]
    # a node comes after itself where it has a key twice
    other = (node != first) & np.concatenate([[True], (key[1:] != key[:-1]) | (node[1:] != node[:-1])])
    return key[new], node[new], np.stack([node[other], first[other], key[other].view(np.int64)], axis=1)


def dealt(first: int, n: int) -> np.ndarray:
    """Partition numbers for rows that need no partition of their own: places from ``first`` on, spread by a hash."""
    return (mix(np.arange(first, first + n, dtype=np.uint64) + _C) >> np.uint64(33)).astype(np.int32)


def _edge_rows(edges: np.ndarray) -> Iterator[pa.RecordBatch]:
    for at in range(0, len(edges), 100_000):
        part = edges[at : at + 100_000]
        yield _rows(p=dealt(at, len(part)), a=part[:, 0], b=part[:, 1], d=part[:, 2])


def _combined(keys: list[np.ndarray], nodes: list[int], parts: int) -> Iterator[pa.RecordBatch]:
    """Distinct keys of a task, a packed block for each of the ranges of keys, and edges inside the task."""
    key = np.concatenate(keys)
    node = np.repeat(np.array(nodes, np.int64), [len(k) for k in keys])
    key, node, edges = _firsts(key, node)
    yield from _edge_rows(edges)
    limits = np.searchsorted(key, np.array([(i << 64) // parts for i in range(1, parts)], dtype=np.uint64))
    for part, (low, high) in enumerate(itertools.pairwise([0, *limits.tolist(), len(key)])):
        if high > low:
            steps = np.diff(key[low:high], prepend=np.uint64(0))
            yield _rows(p=[part], keys=[planes(steps)], nodes=[planes(np.ascontiguousarray(node[low:high]))])


def signatures(docs: DataFrame, size: int, percent: int, parts: int) -> DataFrame:
    """Rows of three kinds: documents (a = doc_id, b = set size, c and d = digest of the set, nodes = its bitmap, mark = digest of the
    text), blocks of keys with their nodes, and edges (a, b) between nodes of one task that share a key, d.  Only distinct keys of a
    task leave it, in ``parts`` ranges of keys.  A node is the first half of the digest of a set, so texts are told apart by
    what they hold, whatever their doc_id."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        slices = Slices(percent)
        keys: list[np.ndarray] = []
        nodes: list[int] = []
        waiting = done = 0
        for batch in batches:
            ids, sizes, digests, marks = batch.column(0).to_pylist(), [], [], []
            for text in batch.column(1):
                hashes = shingle_set(text.as_py(), size)
                sizes.append(len(hashes))
                marks.append(bitmap(hashes, width(len(hashes))).tobytes())
                digests.append(hashlib.blake2b(hashes.tobytes(), digest_size=16).digest())
                if len(hashes):
                    own = np.unique(slices.keys(hashes))
                    keys.append(own)
                    nodes.append(int.from_bytes(digests[-1][:8], "little", signed=True))
                    waiting += len(own)
                if waiting >= KEY_BUFFER:
                    yield from _combined(keys, nodes, parts)
                    keys, nodes, waiting = [], [], 0
            if ids:
                halves = np.frombuffer(b"".join(digests), "<i8").reshape(-1, 2)
                yield _rows(p=dealt(done, len(ids)), a=ids, b=sizes, c=halves[:, 0], d=halves[:, 1], nodes=marks, mark=batch.column(2).to_pylist())
                done += len(ids)
        if keys:
            yield from _combined(keys, nodes, parts)

    return _texts(docs).mapInArrow(run, ROWS_DDL)


def text_mark():
    """The digest of a text; a null text is like an empty one."""
    return F.unhex(F.md5(F.coalesce(F.col("text").cast("string"), F.lit("")).cast("binary")))


def _texts(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"), text_mark().alias("mark"))


def shared_keys(rows: DataFrame) -> DataFrame:
    """Documents (a, b, c, d, nodes, mark) and edges (a, b, d) of ``signatures``, with edges for keys that several tasks hold.

    A key comes from a task once, so no key has more entries than there are tasks.  Of a range of
    keys all blocks are held at once; the ranges are many times as many as the partitions.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        here: int | None = None
        keys: list[np.ndarray] = []
        nodes: list[np.ndarray] = []

        def edges() -> Iterator[pa.RecordBatch]:
            if len(keys) > 1:
                yield from _edge_rows(_firsts(np.concatenate(keys), np.concatenate(nodes))[2])

        for batch in batches:
            block = np.asarray(batch.column("keys").is_valid().to_numpy(zero_copy_only=False))
            rest = batch.filter(pa.array(~block))
            if rest.num_rows:
                yield rest
            blocks = batch.filter(pa.array(block))
            for part, steps, own in zip(*(blocks.column(c) for c in ("p", "keys", "nodes")), strict=True):
                if part.as_py() != here:
                    yield from edges()
                    here, keys, nodes = part.as_py(), [], []
                keys.append(np.cumsum(from_planes(steps.as_py()), dtype=np.uint64))
                nodes.append(from_planes(own.as_py()).view(np.int64))
        yield from edges()

    return rows.repartition("p").sortWithinPartitions("p").mapInArrow(run, ROWS_DDL).drop("p", "keys")


def width(n: int) -> int:
    """Bits of the bitmap of a set: two to four times its size, within bounds."""
    return 1 << min(14, max(8, int(2 * n).bit_length()))


def bitmap(hashes: np.ndarray, bits: int) -> np.ndarray:
    marks = np.zeros(bits, bool)
    marks[(mix(hashes) >> np.uint64(64 - bits.bit_length() + 1)).astype(np.int64)] = True
    return np.packbits(marks).view(np.uint64)


def folded(words: np.ndarray, bits: int) -> np.ndarray:
    """A bitmap with fewer bits: neighbouring bits fall together, as their hashes do."""
    marks = np.unpackbits(words.view(np.uint8)).reshape(bits, -1)
    return np.packbits(marks.any(axis=1)).view(np.uint64)


class Tree:
    """Bitmaps of sets with the OR-combined nodes above them; level 0 is the sets.

    ``order`` sorts the sets; neighbours should be alike, so that the nodes above them stay sparse.
    """

    def __init__(self, words: np.ndarray, sizes: np.ndarray, alike: np.ndarray):
        self.order = np.lexsort((sizes, alike))
        words, small = words[self.order], sizes[self.order]
        slack = small - np.bitwise_count(words).sum(axis=1, dtype=np.int64)
        self.levels = [(words, small, small, slack)]
        while len(self.levels[-1][0]) > 1:
            words, least, most, slack = self.levels[-1]
            starts = np.arange(0, len(words), FAN)
            self.levels.append((np.bitwise_or.reduceat(words, starts), np.minimum.reduceat(least, starts), np.maximum.reduceat(most, starts), np.maximum.reduceat(slack, starts)))

    def same(self, labels: np.ndarray) -> list[np.ndarray]:
        """For each level, the component that all sets below a node are in, or -1."""
        out = [labels[self.order]]
        for _ in self.levels[1:]:
            starts = np.arange(0, len(out[-1]), FAN)
            low, high = np.minimum.reduceat(out[-1], starts), np.maximum.reduceat(out[-1], starts)
            out.append(np.where(low == high, low, -1))
        return out


def possible(left: Tree, at_l: int, right: Tree, at_r: int, i: np.ndarray, j: np.ndarray, percent: int) -> np.ndarray:
    """Which node pairs may hold a linked pair.

    Shingles of an overlap set bits in both bitmaps; a set has at most ``slack`` more shingles than bits,
    so no overlap below the nodes exceeds the common bits and the smaller slack, nor the smaller size.
    """
    keep = np.zeros(len(i), bool)
    words_l, least_l, most_l, slack_l = left.levels[at_l]
    words_r, least_r, most_r, slack_r = right.levels[at_r]
    step = max(1, 4_000_000 // words_l.shape[1])
    for at in range(0, len(i), step):
        x, y = i[at : at + step], j[at : at + step]
        fits = (100 * most_l[x] >= percent * least_r[y]) & (100 * most_r[y] >= percent * least_l[x])
        x, y = x[fits], y[fits]
        common = np.bitwise_count(words_l[x] & words_r[y]).sum(axis=1, dtype=np.int64)
        overlap = np.minimum(common + np.minimum(slack_l[x], slack_r[y]), np.minimum(most_l[x], most_r[y]))
        keep[at : at + step][fits] = overlap * (100 + percent) >= percent * (least_l[x] + least_r[y])
    return keep


class Forest:
    """Union-find over the sets of one task."""

    def __init__(self, n: int):
        self.up = list(range(n))

    def find(self, x: int) -> int:
        while self.up[x] != x:
            self.up[x] = self.up[self.up[x]]
            x = self.up[x]
        return x

    def join(self, x: int, y: int) -> bool:
        x, y = self.find(x), self.find(y)
        self.up[max(x, y)] = min(x, y)
        return x != y

    def labels(self) -> np.ndarray:
        return np.array([self.find(x) for x in range(len(self.up))])


def linked_pairs(sets: list[np.ndarray], first: int | None, percent: int) -> tuple[list[tuple[int, int]], int]:
    """Edges that span the components of distinct sets, and the number of exact comparisons.

    ``first``: the sets before this place are one cell and the rest another, and only pairs across are
    looked for; None looks at all pairs.
    """
    if len(sets) < 2:
        return [], 0
    bits = width(max(map(len, sets)))

    def linked(x: int, y: int) -> bool:
        a, b = sets[x], sets[y]
        return bool(links(len(np.intersect1d(a, b, assume_unique=True)), len(a), len(b), percent))

    # near copies share their smallest hash more often than not: they become neighbours
    words = np.array([bitmap(s, bits) for s in sets])
    return traversed(words, np.array([len(s) for s in sets]), np.array([s[0] for s in sets]), first, percent, linked)


def possible_pairs(words: list[np.ndarray], sizes: list[int], first: int | None, percent: int) -> list[tuple[int, int]]:
    """Edges that span the components of pairs that may link, as far as bitmaps tell; as ``linked_pairs``."""
    if len(words) < 2:
        return []
    bits = 64 * min(map(len, words))
    matrix = np.array([w if 64 * len(w) == bits else folded(w, bits) for w in words])
    if first is None and len(words) <= FAN:
        # most keys have few sets, for which a tree takes longer than all pairs
        n = np.array(sizes)
        common = np.bitwise_count(matrix[:, None] & matrix).sum(axis=2, dtype=np.int64)
        slack = n - common.diagonal()
        overlap = np.minimum(common + np.minimum(slack[:, None], slack), np.minimum(n[:, None], n))
        return [(x, y) for x, y in np.argwhere(overlap * (100 + percent) >= percent * (n[:, None] + n)).tolist() if x < y]
    return traversed(matrix, np.array(sizes), matrix[:, 0], first, percent, None)[0]


def traversed(words, lengths, alike, first: int | None, percent: int, linked) -> tuple[list[tuple[int, int]], int]:
    """The dual traversal; ``linked`` decides on pairs that reach the leaves, None takes them all."""
    forest, edges, compared = Forest(len(words)), [], 0
    split = len(words) if first is None else first
    left = Tree(words[:split], lengths[:split], alike[:split])
    right = left if first is None else Tree(words[split:], lengths[split:], alike[split:])
    base = 0 if first is None else split
    depth = max(len(left.levels), len(right.levels))

    def compare(x: np.ndarray, y: np.ndarray) -> None:
        nonlocal compared
        for one, two in zip(x.tolist(), y.tolist(), strict=True):
            if forest.find(one) == forest.find(two):
                continue
            compared += 1
            if linked is None or linked(one, two):
                forest.join(one, two)
                edges.append((one, two))

    if first is None:
        i = np.arange(split - 1)
        i = i[possible(left, 0, left, 0, i, i + 1, percent)]
        compare(left.order[i], left.order[i + 1])

    labels = forest.labels()
    same_l = left.same(labels[:split])
    same_r = same_l if first is None else right.same(labels[split:])
    i = j = np.zeros(1, np.int64)
    for level in range(depth - 1, -1, -1):
        at_l, at_r = min(level, len(left.levels) - 1), min(level, len(right.levels) - 1)
        one, two = same_l[at_l][i], same_r[at_r][j]
        apart = (one != two) | (one < 0)
        i, j = i[apart], j[apart]
        keep = possible(left, at_l, right, at_r, i, j, percent)
        i, j = i[keep], j[keep]
        if level:
            i, j = crossed(children(i, left, at_l, level), children(j, right, at_r, level))
            if first is None:
                i, j = i[i <= j], j[i <= j]
    if first is None:
        i, j = i[i < j], j[i < j]
    x, y = left.order[i], right.order[j] + base
    while len(x):
        compare(x[:4096], y[:4096])
        x, y = x[4096:], y[4096:]
        labels = forest.labels()
        apart = labels[x] != labels[y]
        x, y = x[apart], y[apart]
    return edges, compared


def children(nodes: np.ndarray, tree: Tree, at: int, level: int) -> np.ndarray:
    """Children of each node on the level below, -1 where there is none; above its root a tree waits."""
    if at < level:
        return nodes[:, None]
    below = nodes[:, None] * FAN + np.arange(FAN)
    return np.where(below < len(tree.levels[at - 1][0]), below, -1)


def crossed(one: np.ndarray, two: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    i, j = np.repeat(one, two.shape[1], axis=1).ravel(), np.tile(two, (1, one.shape[1])).ravel()
    there = (i >= 0) & (j >= 0)
    return i[there], j[there]


#: Columns beside those of a table: the digest of a text, and doc_id and digest of the rows that stay.
MARK, OWN_ID, OWN_MARK = "_text_mark_of_row", "_kept_doc_id", "_kept_text_mark"

MEMBERS = pa.schema([("task", pa.string()), ("side", pa.int32()), ("node", pa.int64()), ("n", pa.int64()), ("data", pa.binary())])


def member_sets(members: DataFrame, size: int) -> DataFrame:
    """The set of every member (node, text, tasks), once for each task it is in; rows of one node have one text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sent: set[int] = set()
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                rows = []
                for node, text, tasks in zip(*(part.column(c).to_pylist() for c in range(3)), strict=True):
                    # rows that repeat id and text stand for one set
                    if node in sent:
                        continue
                    sent.add(node)
                    hashes = shingle_set(text, size)
                    data = hashes.tobytes()
                    rows += [(t["task"], t["side"], node, len(hashes), data) for t in tasks]
                for k in range(0, len(rows), 256):
                    yield pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows[k : k + 256], strict=True), MEMBERS, strict=True)], schema=MEMBERS)

    return members.mapInArrow(run, "task string, side int, node long, n long, data binary")


def task_edges(members: DataFrame, percent: int, exact: bool) -> DataFrame:
    """Edges inside each task; its rows (task, side, node, n, data) come together, one task after the other.

    ``data`` holds the hashes of a set if ``exact``, else its bitmap.
    """

    def solve(nodes: list[int], sides: list[int], sizes: list[int], data: list[bytes]) -> list[tuple[int, int]]:
        seen: dict[tuple[int, bytes], int] = {}
        for n in range(len(nodes)):
            # equal sets are one; equal bitmaps need not be equal sets
            seen.setdefault((sides[n], data[n] if exact else nodes[n]), n)
        chosen = sorted(seen.values(), key=lambda n: sides[n])
        first = sum(1 for n in chosen if sides[n] == 0)
        edges = [(nodes[n], nodes[seen[sides[n], data[n]]]) for n in range(len(nodes))] if exact else []
        if first:
            arrays, split = [np.frombuffer(data[n], np.uint64) for n in chosen], first if first < len(chosen) else None
            found = linked_pairs(arrays, split, percent)[0] if exact else possible_pairs(arrays, [sizes[n] for n in chosen], split, percent)
            edges += [(nodes[chosen[x]], nodes[chosen[y]]) for x, y in found]
        return [e for e in edges if e[0] != e[1]]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        task, held = None, ([], [], [], [])
        schema = pa.schema([("a", pa.int64()), ("b", pa.int64())])

        def edges() -> Iterator[pa.RecordBatch]:
            found = solve(*held) if len(held[0]) > 1 else []
            if found:
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in zip(*found, strict=True)], schema=schema)

        for batch in batches:
            for name, *row in zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True):
                if name != task:
                    yield from edges()
                    task, held = name, ([], [], [], [])
                for column, value in zip(held, row, strict=True):
                    column.append(value)
        yield from edges()

    rows = members.select("task", "node", "side", "n", "data")
    return rows.repartition("task").sortWithinPartitions("task", "side", "node").mapInArrow(run, "a long, b long")


def assigned(members: DataFrame, percent: int) -> DataFrame:
    """Members (node, n, part, ...) with ``tasks``, the comparisons of cells each takes part in, and ``whole``.

    A partition that fits one cell is one task.  A larger one is cut by the level of set sizes and, on
    a level, by a hash into cells; cells of one level and of neighbouring levels are compared pairwise.
    """
    slices = Slices(percent)

    @F.pandas_udf("int")
    def level_of(n):
        return n.map(lambda v: slices.level(int(v))).astype("int32")

    def cuts(sets, shingles):
        return F.greatest(F.ceil(sets / CELL_SETS), F.ceil(shingles / CELL_SHINGLES))

    columns = members.columns
    members = members.withColumn("level", level_of("n"))
    levels = members.groupBy("part", "level").agg(F.count("*").alias("sets"), F.sum("n").alias("shingles"))
    parts = levels.groupBy("part").agg(
        F.sum("sets").alias("all_sets"), F.sum("shingles").alias("all_shingles"),
        F.map_from_entries(F.collect_list(F.struct("level", cuts(F.col("sets"), F.col("shingles")).alias("cut")))).alias("cuts"),
    ).filter("all_sets > 1")
    whole = cuts(F.col("all_sets"), F.col("all_shingles")) == 1
    placed = members.join(parts, "part").withColumn("h", F.pmod(F.xxhash64("node"), F.col("cuts")[F.col("level")]))

    def cells(level, smaller_first):
        """Tasks with every cell of a level."""
        count = F.coalesce(F.try_element_at("cuts", level), F.lit(0))
        others = F.when(count > 0, F.sequence(F.lit(0).cast("long"), count - 1)).otherwise(F.array().cast("array<long>"))
        own, l_own = F.col("h"), F.col("level")

        def task(o):
            mine_first = (F.lit(smaller_first) == 1) | ((F.lit(smaller_first) == 0) & (own <= o))
            one = F.concat_ws(".", l_own, own)
            two = F.concat_ws(".", level, o)
            name = F.concat_ws(":", F.col("part"), F.when(mine_first, one).otherwise(two), F.when(mine_first, two).otherwise(one))
            return F.struct(name.alias("task"), F.when(mine_first, 0).otherwise(1).alias("side"))

        return F.transform(others, task)

    level = F.col("level")
    spread = F.concat(cells(level, 0), cells(level + 1, 1), cells(level - 1, -1))
    single = F.array(F.struct(F.col("part").cast("string").alias("task"), F.lit(0).alias("side")))
    return placed.select(*columns, whole.alias("whole"), F.when(whole, single).otherwise(spread).alias("tasks"))


def sharing(edges: DataFrame, large: DataFrame) -> DataFrame:
    """(node, n, part) of the sets (c, node, n) of ``large``: once for every key, the part, that they share with another of them.

    Linked sets share a key.  Near copies share most of theirs; of keys with the same sets (told by their number and 128 bits of hashes)
    one is kept."""
    held = edges.select(F.col("d").alias("key"), F.explode(F.array("a", "b")).alias("c")).distinct()
    own = stored(held.join(large.select("c", "node", "n"), "c").select("key", "node", "n"), "held")
    lists = own.groupBy("key").agg(
        F.count("*").alias("sets"), F.bit_xor(F.xxhash64("node")).alias("x"), F.bit_xor(F.xxhash64("node", F.lit(1))).alias("y")).filter("sets > 1")
    chosen = lists.groupBy("sets", "x", "y").agg(F.min("key").alias("key")).select("key")
    return own.join(chosen, "key").select("node", "n", F.col("key").alias("part"))


def components_of(docs: DataFrame, size: int, percent: int) -> DataFrame:
    """(doc_id, mark, n_shingles, head) of every row: ``head`` is the row (none, doc_id, mark) that stands for its component.

    It has the smallest doc_id, rows without one last, and of those with one doc_id the smallest digest of a
    text.  Rows with the empty set have none.
    """
    ranges = max(RANGES * int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-docs.select("doc_id").count() // DOCS_TO_RANGE))
    rows = stored(shared_keys(signatures(docs, size, percent, ranges)), "shingle-rows")
    documents = rows.filter("c is not null").select(
        F.col("a").alias("doc_id"), "mark", F.col("b").alias("n_shingles"), "c", "d", F.col("nodes").alias("bits"))
    row = F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "mark")
    sets = documents.filter("n_shingles > 0").groupBy("c", "d").agg(
        F.min(row).alias("rep"), F.max("n_shingles").alias("n"), F.first("bits").alias("bits"))
    # written, so that the numbers of the sets stay and the last join exchanges both of its sides: a set with very many
    # copies can then be split
    sets = stored(sets.withColumn("node", F.monotonically_increasing_id()), "sets")
    edges = rows.filter("c is null")
    parts = connected_components(edges.select("a", "b"), "partitions")
    parts = parts.select(F.col("node").alias("c"), F.col("component").alias("part"))
    members = sets.join(parts, "c").select("c", "node", "n", "part")
    cells = stored(assigned(members, percent), "cells")
    # partitions of more than one cell are looked at key by key and by bitmaps alone first: passages that many texts share join
    # unrelated ones, and what a bitmap already rules out needs no set to be sent
    large = cells.filter("not whole").select("c", "node", "n")
    compared = assigned(sharing(edges, large), percent).select("node", F.explode("tasks").alias("t")).select("t.task", "t.side", "node")
    bitmaps = compared.join(sets.select("node", "n", F.col("bits").alias("data")), "node")
    finer = connected_components(stored(task_edges(bitmaps, percent, False), "candidates"), "finer")
    again = large.select("node", "n").join(finer, "node").select("node", "n", F.col("component").alias("part"))
    tasks = assigned(cells.filter("whole").select("node", "n", "part").unionByName(again), percent).select("node", "tasks")
    tasks = stored(tasks.join(sets.select("node", "rep"), "node").select("node", "tasks", "rep"), "comparisons")
    # the members grow with the table: the join exchanges both sides at every size, and a hot text can be split
    texts = _texts(docs).alias("t").join(
        tasks.hint("merge"), (F.col("t.mark") == F.col("rep.mark")) & F.col("t.doc_id").eqNullSafe(F.col("rep.doc_id"))).select("node", "text", "tasks")
    edges = stored(task_edges(member_sets(texts, size), percent, True), "links")
    found = connected_components(edges, "components").join(sets.select("node", "rep"), "node")
    heads = found.groupBy("component").agg(F.min("rep").alias("head"))
    heads = found.select("node", "component").join(heads, "component").select("node", "head")
    of_set = sets.join(heads, "node", "left").select("c", "d", F.coalesce("head", "rep").alias("head"))
    joined = documents.join(of_set, ["c", "d"], "left")
    return joined.select("doc_id", "mark", "n_shingles", F.when(F.col("n_shingles") > 0, F.col("head")).alias("head"))


def jaccard_components(docs: DataFrame, size: int = 3, percent: int = 90) -> DataFrame:
    """(doc_id, n_shingles, component_id): the smallest doc_id reachable by links from every document.

    Texts that are null, empty or without words have the empty set, which links with nothing.  Rows with equal
    sets form one component.  Rows without a doc_id link by their texts like others, but give no smallest doc_id, and
    their own component_id is null.  Rows that share a doc_id are told apart by their texts: each is in the
    component of its own text.  An empty table gives no rows; columns beyond doc_id and text are not read.
    """
    own = F.coalesce(F.col("head.doc_id"), F.col("doc_id"))
    return components_of(docs, size, percent).select("doc_id", "n_shingles", F.when(F.col("doc_id").isNotNull(), own).alias("component_id"))


def drop_near_duplicates(docs: DataFrame, size: int = 5, percent: int = 80) -> DataFrame:
    """One document of each component, the one with the smallest doc_id, with its columns as they were.

    Rows without a doc_id are compared by their texts and stay only where no row of their component has one; texts under
    one doc_id are apart unless they link.  Rows that repeat doc_id and text count once, whatever their other columns.  Texts without words link
    with nothing: each of their distinct rows (doc_id, text) stays.
    """
    marked = docs.withColumn(MARK, text_mark())
    own = components_of(docs, size, percent).filter(
        "head is null or (mark = head.mark and doc_id <=> head.doc_id)").select(
        F.col("doc_id").alias(OWN_ID), F.col("mark").alias(OWN_MARK)).distinct()
    chosen = marked.join(own, (F.col(MARK) == F.col(OWN_MARK)) & F.col("doc_id").cast("long").eqNullSafe(F.col(OWN_ID)), "left_semi")
    return chosen.dropDuplicates(["doc_id", MARK]).select(*docs.columns)
