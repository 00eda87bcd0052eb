"""Best-two-fit packing of tokenised documents into sequences of fixed length."""

from __future__ import annotations

import json
import math
import re
import zlib
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Documents to a packing group.  A group wastes at most about one sequence, and fits any executor.
DOCS_PER_GROUP = 20_000

_LOADED: dict[str, "ByteEncoder"] = {}

#: White space of the pre-tokenising pattern, and runs of it that its engine is not trusted with: it keeps a
#: step back for each character of a run, and gives up at a million.
BLANKS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LONG_RUN = re.compile(f"[{BLANKS}]{{4096,}}")


def byte_characters() -> dict[str, int]:
    """The printable stand-in of every byte in byte-level vocabulary files, by rule."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + n): b for n, b in enumerate(others)}


class ByteEncoder:
    """Ids of texts under a byte-level BPE file, as packed little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str):
        import public_tokenizers
        import tiktoken

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        back = byte_characters()
        special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        ranks = {bytes(back[c] for c in token): i for token, i in spec["model"]["vocab"].items() if token not in special}
        order = [spec["model"]["vocab"]["".join(pair)] for pair in (m if isinstance(m, list) else m.split(" ") for m in spec["model"]["merges"])]
        if any(a >= b for a, b in zip(order, order[1:], strict=False)):
            raise ValueError(f"{path}: ids do not follow the order of merges")
        self.encoder = tiktoken.Encoding("file", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special)

        self.special = tuple(special)

    def _ordinary(self, text: str) -> bytes:
        return self.encoder.encode_to_numpy(text, allowed_special="all").astype("<u4").tobytes() if text else b""

    def encode(self, text: str) -> bytes:
        """Ids of the whole text.

        A long run of white space is one piece up to its last character, which goes to what follows; it is the
        whole run at the end of the text and before a special token.  Such pieces are cut out here.
        """
        out, at = [], 0
        for run in _LONG_RUN.finditer(text):
            stop = run.end()
            if stop < len(text) and not text.startswith(self.special, stop):
                stop -= 1
            piece = np.array(self.encoder._encode_single_piece(text[run.start() : stop]), dtype="<u4")
            out += (self._ordinary(text[at : run.start()]), piece.tobytes())
            at = stop
        return b"".join([*out, self._ordinary(text[at:])])


def byte_encoder(path: str) -> ByteEncoder:
    if path not in _LOADED:
        _LOADED[path] = ByteEncoder(path)
    return _LOADED[path]


PIECES = "doc_id long, piece int, start long, length long, ids_crc32 long"


def cut(ids: bytes, size: int) -> Iterator[tuple[int, int, int]]:
    """(start, length, checksum) of each piece; only the first may be shorter than ``size``."""
    total = len(ids) // 4
    start, end = 0, total % size or min(total, size)
    while start < total:
        yield start, end - start, zlib.crc32(ids[4 * start : 4 * end])
        start, end = end, end + size


def tokenised_pieces(docs: DataFrame, path: str, size: int, end_id: int) -> DataFrame:
    closing = np.uint32(end_id).astype("<u4").tobytes()

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = byte_encoder(path)
        for batch in batches:
            rows = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                rows += [(doc_id, n, *p) for n, p in enumerate(cut(encoder.encode(text or "") + closing, size))]
            columns = list(zip(*rows, strict=True)) or [()] * 5
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(columns, (pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()), strict=True)],
                names=["doc_id", "piece", "start", "length", "ids_crc32"],
            )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(pieces, PIECES)


class Pool:
    """Lengths not packed yet, with how many there are of each."""

    def __init__(self, lengths: np.ndarray):
        values, counts = np.unique(lengths, return_counts=True)
        self.left = dict(zip(values.tolist(), counts.tolist(), strict=True))
        self.sorted = values.tolist()

    def take(self, length: int) -> None:
        self.left[length] -= 1
        if not self.left[length]:
            self.sorted.pop(bisect_right(self.sorted, length) - 1)

    def give(self, length: int) -> None:
        if not self.left.get(length):
            insort(self.sorted, length)
        self.left[length] = self.left.get(length, 0) + 1

    def largest(self, most: int) -> int:
        """The largest length of at most ``most``; 0 if there is none."""
        at = bisect_right(self.sorted, most)
        return self.sorted[at - 1] if at else 0

    def best_two(self, least: int, most: int) -> tuple[int, int] | None:
        """Two lengths whose sum is the largest in (least, most]."""
        best, found = least, None
        at = bisect_right(self.sorted, most - 1) - 1
        while at >= 0 and 2 * self.sorted[at] > best and best < most:
            a = self.sorted[at]
            b = self.largest(min(a, most - a))
            if b == a and self.left[a] < 2:
                b = self.largest(a - 1)
            if b and a + b > best:
                best, found = a + b, (a, b)
            at -= 1
        return found


def best_two_fit(lengths: np.ndarray, size: int) -> list[list[int]]:
    """Bins of lengths: filled greedily, then the smallest member gives way to two that fit its place better."""
    pool, bins = Pool(lengths), []
    while pool.sorted:
        members, gap = [], size
        while gap and (best := pool.largest(gap)):
            pool.take(best)
            members.append(best)
            gap -= best
        while gap:
            smallest = members[-1]
            pair = pool.best_two(smallest, smallest + gap)
            if not pair:
                break
            for length in pair:
                pool.take(length)
            pool.give(smallest)
            members = sorted([*members[:-1], *pair], reverse=True)
            gap += smallest - sum(pair)
        bins.append(members)
    return bins


PACKED = PIECES + ", sequence_id long, offset long"


def pack_group(pieces: pd.DataFrame, size: int) -> pd.DataFrame:
    """Sequence and offset of every piece of one group; numbers start at group x 2^32."""
    pieces = pieces.sort_values(["doc_id", "piece", "start", "ids_crc32"], kind="stable", na_position="first").reset_index(drop=True)
    lengths = pieces["length"].to_numpy()
    waiting = {int(n): np.flatnonzero(lengths == n)[::-1].tolist() for n in np.unique(lengths)}
    sequence, offset = np.zeros(len(pieces), np.int64), np.zeros(len(pieces), np.int64)
    for number, members in enumerate(best_two_fit(lengths, size)):
        at = 0
        for length in members:
            row = waiting[length].pop()
            sequence[row], offset[row] = number, at
            at += length
    pieces["sequence_id"] = pieces["pack_group"].to_numpy(dtype=np.int64) * 2**32 + sequence
    pieces["offset"] = offset
    return pieces.drop(columns="pack_group")


def pack_documents(docs: DataFrame, path: str, size: int = 1024, end_id: int = 2, docs_per_group: int = DOCS_PER_GROUP) -> DataFrame:
    """One row per piece of every document with its sequence and its place there.

    Documents are dealt to groups of about ``docs_per_group``; each group is packed on its own,
    so neither a task nor the driver sees all pieces; equal rows are told apart by where they were read and spread like others.  A null or empty text is its end token alone.
    An empty table gives no rows.  A null doc_id stays null.
    Columns beyond doc_id and text are not carried over, whatever their names.
    """
    groups = max(1, math.ceil(docs.count() / docs_per_group))
    pieces = tokenised_pieces(docs, path, size, end_id)
    dealt = pieces.withColumn("pack_group", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32", F.monotonically_increasing_id()), F.lit(groups)))
    return dealt.groupBy("pack_group").applyInPandas(lambda g: pack_group(g, size), PACKED)
