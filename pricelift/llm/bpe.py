"""BPE encoding by backtracking over longest matches, and decoding through an offset table.

The encoder never replays merges over a word.  An Aho-Corasick automaton gives the longest
token at every place; a token is accepted if it is compatible with the one before it, that is, if
their joint text has exactly these two tokens.  If not, the next shorter token that is its prefix is
tried, and where none is left the last accepted token is taken back.  A sequence whose neighbours
are all compatible is the one that merging gives.
"""

from __future__ import annotations

import hashlib
import json
import struct
import unicodedata
from collections.abc import Iterator

import ahocorasick
import numpy as np
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from pricelift.llm.common import MEMO, Memo
from pricelift.llm.packing import byte_characters

#: A pair of ids is one integer: the first id, then this many bits of the second.
PAIR_BITS = 24

#: Stands for the end-of-word suffix while matching; no byte stand-in uses it.
END = "\x00"

#: White space as Unicode has it; str.split() also cuts at the four separators x1c-x1f.
NOT_SPACE = "\x1c\x1d\x1e\x1f"
SPACES = regex.compile("[\t-\r \x85\xa0  -     　]+")

_LOADED: dict[str, "WordBpe"] = {}


class WordBpe:
    def __init__(self, path: str):
        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        model = spec["model"]
        self.suffix = model["end_of_word_suffix"] or ""
        self.special = {t["content"]: t["id"] for t in spec["added_tokens"]}
        self.special_pattern = regex.compile("(" + "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True)) + ")")
        self.pattern = regex.compile(next(p for p in spec["pre_tokenizer"]["pretokenizers"] if p["type"] == "Split")["pattern"]["Regex"])
        self.byte_char = {b: c for c, b in byte_characters().items()}
        plain = {t: i for t, i in model["vocab"].items() if t not in self.special}
        self.id_of = {self._inner(t): i for t, i in plain.items()}
        pairs = (m if isinstance(m, list) else m.split(" ") for m in model["merges"])
        self.rank = {(self.id_of[self._inner(a)], self.id_of[self._inner(b)]): (n, self.id_of[self._inner(a + b)]) for n, (a, b) in enumerate(pairs)}
        self.text_of = {i: t for t, i in self.id_of.items()}
        self.shorter = {i: next((self.id_of[t[:k]] for k in range(len(t) - 1, 0, -1) if t[:k] in self.id_of), -1) for t, i in self.id_of.items()}
        self.size_of = {i: len(t) for t, i in self.id_of.items()}
        if max(self.id_of.values()) >= 1 << PAIR_BITS:
            raise ValueError(f"{path}: more ids than a pair can hold")
        self.automaton = ahocorasick.Automaton()
        for t, i in self.id_of.items():
            self.automaton.add_word(t, (len(t), i))
        self.automaton.make_automaton()
        self.pair_table = Memo(self._fits, 2 * MEMO)
        self.words = Memo(self._word)
        self.chunks = Memo(self._chunk, MEMO // 2)
        self.offsets = self._offset_table(model["vocab"] | self.special)

    def _inner(self, token: str) -> str:
        if self.suffix and token.endswith(self.suffix) and len(token) > len(self.suffix):
            return token[: -len(self.suffix)] + END
        return token

    def _symbols(self, inner: str) -> list[int]:
        last = inner.endswith(END)
        units = [*inner[:-2], inner[-2:]] if last else [*inner]
        return [self.id_of[u] for u in units]

    def _merged(self, ids: list[int]) -> list[int]:
        """Plain merging, for the few tokens of one table entry only."""
        while len(ids) > 1:
            best = min(((self.rank[p][0], n) for n, p in enumerate(zip(ids, ids[1:], strict=False)) if p in self.rank), default=None)
            if best is None:
                break
            n = best[1]
            ids[n : n + 2] = [self.rank[ids[n], ids[n + 1]][1]]
        return ids

    def _fits(self, pair: int) -> bool:
        """The pair-compatibility table: both tokens side by side are what their joint text merges to."""
        first, second = pair >> PAIR_BITS, pair & ((1 << PAIR_BITS) - 1)
        if first < 0:
            return self._merged(self._symbols(self.text_of[second])) == [second]
        if self.text_of[first].endswith(END):
            return False
        return self._merged(self._symbols(self.text_of[first]) + self._symbols(self.text_of[second])) == [first, second]

    def backtrack(self, word: str) -> list[int]:
        # ends only grow, so the last match kept for a place is the longest that starts there
        longest = {end - found[0] + 1: found[1] for end, found in self.automaton.iter(word)}
        size, fits, shorter, size_of = len(word), self.pair_table, self.shorter, self.size_of
        taken: list[int] = []
        dead: set[int] = set()
        at, before = 0, -1
        token = longest.get(0, -1)
        while at < size:
            while token >= 0:
                end = at + size_of[token]
                if end not in dead and (end == size or end in longest) and fits[before << PAIR_BITS | token]:
                    break
                token = shorter[token]
            if token >= 0:
                taken.append(token)
                at, before = end, token
                token = longest.get(at, -1)
            elif taken:
                dead.add(at)
                token = taken.pop()
                at -= size_of[token]
                before = taken[-1] if taken else -1
                token = shorter[token]
            else:
                raise ValueError("no sequence of tokens covers the word")
        return taken

    def _word(self, word: str) -> bytes:
        mapped = "".join([self.byte_char[b] for b in word.encode("utf-8")])
        ids = self.backtrack(mapped + END if self.suffix else mapped)
        return struct.pack(f"<{len(ids)}I", *ids)

    def _chunk(self, chunk: str) -> bytes:
        text = chunk.lower() if chunk.isascii() else unicodedata.normalize("NFC", chunk).replace("Σ", "σ").lower()
        words = self.words
        return b"".join([words[w] for w in self.pattern.findall(text)])

    def _plain(self, text: str) -> bytes:
        chunks = SPACES.split(text) if any(c in text for c in NOT_SPACE) else text.split()
        return b"".join(map(self.chunks.__getitem__, chunks))

    def encode(self, text: str) -> bytes:
        """Ids as little-endian unsigned 32-bit integers."""
        if any(s in text for s in self.special):
            ids = {s: np.uint32(i).astype("<u4").tobytes() for s, i in self.special.items()}
            return b"".join([ids[part] if part in ids else self._plain(part) for part in self.special_pattern.split(text) if part])
        return self._plain(text)

    @staticmethod
    def _offset_table(vocab: dict[str, int]) -> pa.Array:
        """Texts of all ids, a space behind each, as one run of bytes with the offset of each id."""
        parts = [b""] * (max(vocab.values()) + 1)
        for token, i in vocab.items():
            parts[i] = token.encode("utf-8") + b" "
        return pa.array(parts, pa.large_binary())

    def decode(self, ids: bytes) -> bytes:
        """The tokens of packed ids, joined by one space, in UTF-8; a file without a decoder is read so."""
        if not ids:
            return b""
        taken = self.offsets.take(pa.array(np.frombuffer(ids, dtype="<u4")))
        _, offsets, data = taken.buffers()
        end = np.frombuffer(offsets, dtype=np.int64)[len(taken)]
        return data[: end - 1].to_pybytes()


def word_bpe(path: str) -> WordBpe:
    if path not in _LOADED:
        _LOADED[path] = WordBpe(path)
    return _LOADED[path]


def encode_documents(docs: DataFrame, path: str) -> DataFrame:
    """doc_id with ``ids`` (packed little-endian unsigned 32-bit) and ``decoded`` (UTF-8) of every whole text.

    A null or empty text has no ids and decodes to nothing.  Equal rows give equal rows; an empty table
    stays empty; columns beyond doc_id and text are not read.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            ids = [bpe.encode(text or "") for text in batch.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(ids, pa.binary()), pa.array([bpe.decode(i) for i in ids], pa.binary())],
                names=["doc_id", "ids", "decoded"],
            )

    return _whole(docs).mapInArrow(run, "doc_id long, ids binary, decoded binary")


def token_digests(docs: DataFrame, path: str) -> DataFrame:
    """Count and digest of the ids and digest of the decoded text of every document.

    The digests are taken where the ids are made, so neither ids nor decoded texts leave the worker.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bpe = word_bpe(path)
        for batch in batches:
            counts, digests, back = [], [], []
            for text in batch.column(1).to_pylist():
                ids = bpe.encode(text or "")
                counts.append(len(ids) // 4)
                digests.append(hashlib.sha256(ids).hexdigest())
                back.append(hashlib.sha256(bpe.decode(ids)).hexdigest())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), pa.array(counts, pa.int64()), pa.array(digests, pa.string()), pa.array(back, pa.string())],
                names=["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"],
            )

    return _whole(docs).mapInArrow(run, "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string")


def _whole(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
