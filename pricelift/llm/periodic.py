"""Periodic runs of words: suffix trees of a text and of its reversal extend the roots of all runs both ways.

By the runs theorem every maximal run holds a root that is the longest Lyndon word starting at its place, under the
order of the words or under the opposite one.  Both orders are read off one suffix tree (Ukkonen), so there are at
most two candidates a place.  Each is extended by longest common extensions: to the right in the tree of the text,
to the left in that of its reversal.  An extension is the depth of a lowest common ancestor, the least depth an Euler
tour meets between two leaves, answered in constant time from a table of minima.
"""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The shortest run counted, in words; a run also holds its period twice at least.
LEAST_RUN = 12

#: Odd multiplier that hashes windows of words; it steers the search only, no result depends on it.
MIX = np.uint64(0x9E3779B97F4A7C15)

RUNS = "array<struct<start:bigint,length:bigint,period:bigint>>"


class SuffixTree:
    """Ukkonen's suffix tree of integers from 1 on, closed by a 0; suffixes in order and their common beginnings."""

    def __init__(self, symbols: list[int]):
        self.text = [*symbols, 0]
        self.size = len(self.text)
        self.width = max(self.text) + 1
        self._grow()
        self._tour()

    def _grow(self) -> None:
        text, width, size = self.text, self.width, self.size
        start, stop, link, edges = [0], [0], [0], {}
        node = edge = length = waiting = 0
        for at, symbol in enumerate(text):
            split = 0  # the inner node made last, which still lacks its suffix link
            waiting += 1
            while waiting:
                if not length:
                    edge = at
                key = node * width + text[edge]
                child = edges.get(key)
                if child is None:
                    edges[key] = len(start)
                    start.append(at)
                    stop.append(size)
                    link.append(0)
                    if split:
                        link[split] = node
                        split = 0
                else:
                    first = start[child]
                    span = stop[child] - first
                    if length >= span:
                        edge += span
                        length -= span
                        node = child
                        continue
                    if text[first + length] == symbol:
                        if split:
                            link[split] = node
                        length += 1
                        break
                    inner = len(start)
                    start += (first, at)
                    stop += (first + length, size)
                    link += (0, 0)
                    edges[key] = inner
                    edges[inner * width + symbol] = inner + 1
                    start[child] = first + length
                    edges[inner * width + text[first + length]] = child
                    if split:
                        link[split] = inner
                    split = inner
                waiting -= 1
                if node:
                    node = link[node]
                elif length:
                    length -= 1
                    edge = at - waiting + 1
        keys = np.fromiter(edges.keys(), np.int64, len(edges))
        order = np.argsort(keys)
        self.children = np.fromiter(edges.values(), np.int64, len(edges))[order].tolist()
        self.firsts = np.searchsorted(keys[order] // width, np.arange(len(start) + 1)).tolist()
        self.spans = [b - a for a, b in zip(start, stop, strict=True)]
        # only a leaf can hang on the closing 0
        self.closing = {edges[k] for k in edges if k % width == 0}

    def _tour(self) -> None:
        """Euler tour of depths; from it the order of the suffixes and the table of least depths between neighbours."""
        firsts, children, spans = self.firsts, self.children, self.spans
        depth, following = [0] * len(spans), firsts[:-1]
        tour, place, self.suffix = [0], [0] * self.size, {}
        path = [0]
        while path:
            node = path[-1]
            at = following[node]
            if at == firsts[node + 1]:
                path.pop()
                if path:
                    tour.append(depth[path[-1]])
                continue
            following[node] = at + 1
            child = children[at]
            below = depth[node] + spans[child]
            if firsts[child] == firsts[child + 1]:
                self.suffix[child] = self.size - below
                place[self.size - below] = len(tour)
                tour += (below, depth[node])
            else:
                depth[child] = below
                tour.append(below)
                path.append(child)
        places = np.array(place)
        order = np.argsort(places)
        self.rank = np.empty(self.size, np.int64)
        self.rank[order] = np.arange(self.size)
        least = np.minimum.reduceat(np.array(tour, np.int32), places[order])[:-1]
        self.table = [least]
        while 2 << (len(self.table) - 1) <= len(least):
            half = 1 << (len(self.table) - 1)
            last = self.table[-1]
            self.table.append(np.minimum(last[:-half], last[half:]))

    def opposite_rank(self) -> np.ndarray:
        """Places of the suffixes when the order of symbols is turned round; a suffix still follows its beginnings."""
        firsts, children, closing, suffix = self.firsts, self.children, self.closing, self.suffix
        rank, seen, path = np.empty(self.size, np.int64), 0, [0]
        while path:
            node = path.pop()
            low, high = firsts[node], firsts[node + 1]
            if low == high:
                rank[suffix[node]] = seen
                seen += 1
            elif children[low] in closing:
                path += children[low + 1 : high]
                path.append(children[low])
            else:
                path += children[low:high]
        return rank

    def extension(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """How far the suffixes at a and at b, two different places each, agree."""
        low, high = np.minimum(self.rank[a], self.rank[b]), np.maximum(self.rank[a], self.rank[b])
        level = np.frexp((high - low).astype(np.float64))[1] - 1
        out = np.empty(len(low), np.int64)
        for k in np.unique(level):
            here = level == k
            row = self.table[k]
            out[here] = np.minimum(row[low[here]], row[high[here] - (1 << int(k))])
        return out


def lyndon_ends(rank: np.ndarray) -> np.ndarray:
    """Where the longest Lyndon word at each place ends: at the next smaller suffix."""
    ranks = rank.tolist()
    ends, open_ = [0] * (len(ranks) - 1), [len(ranks) - 1]
    for at in range(len(ranks) - 2, -1, -1):
        own = ranks[at]
        while ranks[open_[-1]] > own:
            open_.pop()
        ends[at] = open_[-1]
        open_.append(at)
    return np.array(ends, np.int64)


def runs_of_symbols(symbols: list[int], least: int) -> np.ndarray:
    """(start, length, period) of every maximal run of ``least`` symbols or more, in order."""
    size = len(symbols)
    tree = SuffixTree(symbols)
    places = np.tile(np.arange(size), 2)
    ends = np.concatenate([lyndon_ends(tree.rank), lyndon_ends(tree.opposite_rank())])
    stops = ends + tree.extension(places, ends)
    del tree
    period = ends - places
    # a run holds its period twice and has at most all symbols
    able = 2 * period <= size
    places, ends, stops, period = places[able], ends[able], stops[able], period[able]
    back = SuffixTree(symbols[::-1])
    starts = places - back.extension(size - places, size - ends)
    length = stops - starts
    good = length >= np.maximum(least, 2 * period)
    return np.unique(np.column_stack([starts, length, period])[good], axis=0)


def covered(hashes: np.ndarray, window: int, least: int) -> list[tuple[int, int]]:
    """Stretches of at least ``least`` words that are covered by windows found twice or more."""
    if len(hashes) < least:
        return []
    places = len(hashes) - window + 1
    mixed = np.zeros(places, np.uint64)
    for k in range(window):
        mixed = (mixed + hashes[k : places + k]) * MIX
    ordered = np.sort(mixed)
    again = ordered[1:][ordered[1:] == ordered[:-1]]
    if not len(again):
        return []
    near = again[np.minimum(np.searchsorted(again, mixed), len(again) - 1)] == mixed
    change = np.zeros(len(hashes) + 1, np.int64)
    change[:places] += near
    change[window:] -= near
    inside = np.concatenate([[0], np.cumsum(change[:-1]) > 0, [0]]).astype(np.int8)
    edges = np.flatnonzero(np.diff(inside)).reshape(-1, 2)
    return [(a, b) for a, b in edges.tolist() if b - a >= least]


def stretches(hashes: np.ndarray, least: int) -> Iterator[tuple[int, int]]:
    """Parts of a text outside which no run has a word, each with every run that touches it whole.

    A run of length n and period q repeats its first n - q words q later, and these and their copies cover it.  As
    n - q is at least half of ``least``, every word of a run is in a window of that size found twice in the run.  So
    parts are narrowed as long as many windows in them are not found twice in the part itself.  Equal hashes of different
    windows only widen a part.
    """
    window = least // 2
    waiting = [(0, len(hashes))]
    while waiting:
        start, stop = waiting.pop()
        parts = [(start + a, start + b) for a, b in covered(hashes[start:stop], window, least)]
        # a part that hardly shrinks is good enough: so all narrowing takes a few passes' time
        if sum(b - a for a, b in parts) * 8 > (stop - start) * 7:
            yield from parts
        else:
            waiting += parts


def runs_of(words: list[bytes], least: int = LEAST_RUN) -> np.ndarray:
    """(start, length, period) of every maximal run of words, by start, then period."""
    if len(words) < least:
        return np.zeros((0, 3), np.int64)
    found = [np.zeros((0, 3), np.int64)]
    hashes = np.fromiter(map(hash, words), np.int64, len(words)).view(np.uint64)
    for start, stop in stretches(hashes, least):
        ids: dict[bytes, int] = {}
        runs = runs_of_symbols([ids.setdefault(w, len(ids) + 1) for w in words[start:stop]], least)
        found.append(runs + np.array([start, 0, 0]))
    runs = np.concatenate(found)
    return runs[np.lexsort((runs[:, 2], runs[:, 0]))]


def collapse(words: list[bytes], runs: np.ndarray) -> list[bytes]:
    """The words that no run holds behind its first period."""
    if not len(runs):
        return words
    change = np.zeros(len(words) + 1, np.int64)
    np.add.at(change, runs[:, 0] + runs[:, 2], 1)
    np.add.at(change, runs[:, 0] + runs[:, 1], -1)
    keep = np.cumsum(change[:-1]) == 0
    return [words[n] for n in np.flatnonzero(keep).tolist()]


def find_runs(docs: DataFrame, least: int = LEAST_RUN, edit: Callable[[int | None, list[bytes]], list[bytes]] | None = None) -> DataFrame:
    """doc_id, runs (start, length, period; by start, then period) and collapsed text of every document.

    Words are what ASCII white space separates, of the whole text, and numbered from 0.  ``edit`` may change the words
    of a document first.  A text that is null, empty or white space has no runs and an empty collapsed text; any text
    collapses to its kept words with one space between them.  Rows do not see each other: repeated rows give equal
    results, a null doc_id stays null, an empty table gives no rows.  Other columns are not carried over.

    Memory grows with the longest stretch that repeats itself, about 1 KB a word of it; no text is cut.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, spans, texts, sizes = batch.column(0), [], [], [0]
            for doc_id, text in zip(ids.to_pylist(), batch.column(1), strict=True):
                # bytes split at ASCII white space only
                words = (text.as_py() or b"").split()
                if edit:
                    words = edit(doc_id, words)
                runs = runs_of(words, least)
                spans.append(runs)
                sizes.append(sizes[-1] + len(runs))
                texts.append(b" ".join(collapse(words, runs)))
            flat = np.concatenate(spans) if spans else np.zeros((0, 3), np.int64)
            rows = pa.StructArray.from_arrays([pa.array(np.ascontiguousarray(flat[:, k])) for k in range(3)], names=["start", "length", "period"])
            lists = pa.ListArray.from_arrays(pa.array(sizes, pa.int32()), rows)
            yield pa.RecordBatch.from_arrays([ids, lists, pa.array(texts, pa.binary())], names=["doc_id", "runs", "collapsed"])

    read = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").cast("binary").alias("text"))
    found = read.mapInArrow(run, f"doc_id long, runs {RUNS}, collapsed binary")
    return found.withColumn("collapsed", F.col("collapsed").cast("string"))


def longest(runs: Column) -> Column:
    """The run of greatest length; ties: the smallest start, then the smallest period.  Null where there is none."""
    key = lambda r: F.struct((-r["length"]).alias("a"), r["start"].alias("start"), r["period"].alias("period"), r["length"].alias("length"))
    return F.array_min(F.transform(runs, key))


def run_digests(found: DataFrame) -> DataFrame:
    """One row per document of ``find_runs``: number of runs, the longest one, digests of all runs and of the collapsed text."""
    line = lambda r: F.concat(r["start"].cast("string"), F.lit(","), r["length"].cast("string"), F.lit(","), r["period"].cast("string"), F.lit("\n"))
    best = found.withColumn("best", longest(F.col("runs")))
    return best.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), F.col("best.start").alias("start"), F.col("best.length").alias("length"),
        F.col("best.period").alias("period"), F.floor(1000 * F.col("best.length") / F.col("best.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(F.transform("runs", line), "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed").cast("binary"), 256).alias("collapsed_sha256"),
    )


def planted_tail(doc_id: int | None, words: list[bytes]) -> list[bytes]:
    """The words of a document, the last ones periodic where the checksum of its id is a multiple of ten; a null id changes nothing."""
    h = zlib.crc32(str(doc_id).encode()) if doc_id is not None else 1
    n = len(words)
    if h % 10 or not n:
        return words
    g = h // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    return words[:a] + [words[a + k % p] for k in range(n - a)]
