"""Toxicity of noisy text: restore it through a noisy channel, then score the restored words.

A token that may be disguised (signs or digits among or around letters, a doubled character) and a run of
fragments of at most three characters become a lattice: at every place the letters it may stand for, itself, or
nothing, each at a cost.  Viterbi decoding under a character trigram model of the corpus picks the
reading.  Any other token has one path only, itself.  Evidence of restored words is learned from labels.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from pricelift.llm.common import MEMO, Memo

#: Characters of the language model: 0 ends a word, 1-26 are a-z, then Latin-1 letters, other letters, digits, signs.
SIZE = 64
OTHER_LETTER, DIGIT, SIGN = 61, 62, 63

#: Letters that signs and digits stand for in disguised words.  Fixed values.
STANDS_FOR = {
    "0": "o", "1": "il", "2": "z", "3": "e", "4": "a", "5": "s", "6": "bg", "7": "t", "8": "b", "9": "g", "@": "a", "$": "s",
    "!": "i", "|": "il", "+": "t", "€": "e", "£": "l", "(": "c", "<": "c", "*": "aeiou", "#": "h", "%": "x",
}
#: Costs of the channel in nats: a letter written as a sign, a sign put between letters, a letter repeated, a space put in.
WRITTEN, PUT_IN, REPEATED, SPACED = 1.5, 1.5, 1.0, 0.5
#: A sign put before or behind a word: dearer, as what is kept there splits off anyway.
PUT_AROUND = 3.0

#: Rows the classifier is fitted on, and word features it keeps: bounds of what comes to the driver.
LABELLED_ROWS = 20_000
FEATURES = 20_000
#: A feature must occur in this many labelled texts and speak for toxicity by this many nats.
LEAST_TEXTS, LEAST_WEIGHT = 5, 3.0

FOLDS = 5

#: Marks a space that was put in, in what is read.
JOINED = "\x1f"

_DOUBLE = re.compile(r"(.)\1")
_APART = re.compile(r"(?<!\S)\S{1,3}(?:\s+\S{1,3})+[^\w\s]*(?!\S)")
#: What ends a word in restored text.
_ENDS = re.compile(r"[\W\d_]")


def bared(text: str) -> str:
    """The text without the signs at its edges that stand for no letter."""
    start, stop = 0, len(text)
    while start < stop and not (text[start].isalnum() or text[start] == "_" or text[start] in STANDS_FOR):
        start += 1
    while stop > start and not (text[stop - 1].isalnum() or text[stop - 1] == "_" or text[stop - 1] in STANDS_FOR):
        stop -= 1
    return text[start:stop]


def at_edges(text: str) -> list[bool]:
    """For every place, whether only signs stand between it and a space, or an end of the text."""
    out, edge = [], True
    for char in text:
        out.append(edge)
        edge = char.isspace() or edge and not char.isalnum()
    edge = True
    for at in range(len(text) - 1, -1, -1):
        out[at] = out[at] or edge
        edge = text[at].isspace() or edge and not text[at].isalnum()
    return out


def symbol(char: str) -> int:
    code = ord(char)
    if 97 <= code <= 122:
        return code - 96
    if 0xDF <= code <= 0xFF and code != 0xF7:
        return 27 + code - 0xDF
    return OTHER_LETTER if char.isalpha() else DIGIT if char.isdigit() else SIGN


_SYMBOLS = np.array([0] + [symbol(chr(c)) for c in range(1, 0x250)], np.int64)


def symbols(text: str) -> np.ndarray:
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    return np.where(codes < len(_SYMBOLS), _SYMBOLS[np.minimum(codes, len(_SYMBOLS) - 1)], OTHER_LETTER)


def trigram_counts(docs: DataFrame) -> DataFrame:
    """(trigram, n) over all words of all texts, each occurrence counted.

    A task counts its words first and sends at most SIZE^3 sums.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(SIZE**3)
        for batch in batches:
            words: Counter[str] = Counter()
            for text in batch.column(0).to_pylist():
                words.update((text or "").lower().split())
            if not words:
                continue
            run_ = symbols("\0\0" + "\0\0".join(words) + "\0\0")
            # the weight of a word covers its letters and the end behind it
            spans = np.fromiter(map(len, words), np.int64, len(words)) + 2
            weights = np.repeat(np.fromiter(words.values(), np.int64, len(words)), spans)
            codes = (run_[:-2] * SIZE + run_[1:-1]) * SIZE + run_[2:]
            total += np.bincount(codes, weights, minlength=SIZE**3)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64()), pa.array(total[found].astype(np.int64))], names=["trigram", "n"])

    counted = docs.select(F.col("text").cast("string").alias("text")).mapInArrow(run, "trigram long, n long")
    return counted.groupBy("trigram").agg(F.sum("n").alias("n"))


def language_model(docs: DataFrame) -> np.ndarray:
    """Log-probabilities of a character after two others, SIZE^3 numbers however large the corpus is."""
    counts = np.zeros(SIZE**3)
    for row in trigram_counts(docs).collect():
        counts[row["trigram"]] = row["n"]
    three = counts.reshape(SIZE, SIZE, SIZE)
    two, one = three.sum(axis=0), three.sum(axis=(0, 1))
    p1 = (one + 1) / (one.sum() + SIZE)
    p2 = (two + 5 * p1) / (two.sum(axis=1, keepdims=True) + 5)
    p3 = (three + 5 * p2) / (three.sum(axis=2, keepdims=True) + 5)
    return np.log(p3).astype(np.float32)


class Restorer:
    """Reads disguised tokens as the words that most likely stand behind them."""

    def __init__(self, model: np.ndarray):
        self.cost = (-model).tolist()
        self.words = Memo(self.read)
        self.runs = Memo(self.join, MEMO // 4)

    def _readings(self, text: str, at: int, edges: list[bool]) -> list[tuple[str, float]]:
        char = text[at]
        if char.isspace():
            return [(" ", 0.0), ("", SPACED)]
        out = [(char, 0.0)]
        if at and char == text[at - 1]:
            out.append(("", REPEATED))
        if not char.isalpha():
            out += [(letter, WRITTEN) for letter in STANDS_FOR.get(char, "")]
            if not char.isdigit():
                out.append(("", PUT_AROUND if edges[at] else PUT_IN))
        return out

    def decode(self, text: str) -> str:
        """The cheapest path through the lattice of a token or a run of fragments; JOINED where a space is left out."""
        # state: the last two symbols -> (cost, link to what was read)
        states: dict[tuple[int, int], tuple[float, tuple | None]] = {(0, 0): (0.0, None)}
        edges = at_edges(text)
        for at in range(len(text)):
            reached: dict[tuple[int, int], tuple[float, tuple | None]] = {}
            own = text[at]
            # most characters of most tokens stand for themselves only
            alone = own.isalpha() and not (at and own == text[at - 1])
            for char, price in ((own, 0.0),) if alone else self._readings(text, at, edges):
                to = 0 if char in ("", " ") else symbol(char)
                for (one, two), (cost, link) in states.items():
                    if char == "":
                        state, total, new = (one, two), cost + price, (JOINED, link) if text[at].isspace() else link
                    elif char == " ":
                        state, total, new = (0, 0), cost + price + self.cost[one][two][0], (" ", link)
                    else:
                        state, total, new = (two, to), cost + price + self.cost[one][two][to], (char, link)
                    if state not in reached or total < reached[state][0]:
                        reached[state] = (total, new)
            states = reached
        _, link = min((cost + self.cost[one][two][0], n, link) for n, ((one, two), (cost, link)) in enumerate(states.items()))[1:]
        out = []
        while link:
            out.append(link[0])
            link = link[1]
        return "".join(reversed(out))

    def plain(self, token: str) -> tuple[str, str]:
        """A token without its edges, and the one word it reads as; no word where the lattice has to tell."""
        bare = bared(token) if not token.isalpha() else token
        word = (bare.isalpha() or bare.replace("'", "").replace("-", "").isalpha() and "-" not in bare) and not _DOUBLE.search(bare)
        return bare, bare if word else ""

    def read(self, token: str) -> tuple[str, ...]:
        """The words behind a token."""
        bare, word = self.plain(token)
        if word:
            return (word,)
        return self.decoded(bare) if any(c.isalpha() for c in bare) else ()

    def decoded(self, bare: str) -> tuple[str, ...]:
        return tuple(w for w in re.split(r"[\W\d_]+", self.decode(bare)) if w)

    def join(self, run: str) -> tuple[str, ...]:
        """The words of a run that stand across its spaces; the others are those of its tokens."""
        run = bared(run)
        if not any(c.isalpha() for c in run):
            return ()
        parts = run.split(" ")
        if "".join(parts).isalpha() and min(map(len, parts)) > 1 and not _DOUBLE.search(run):
            return self.join_plain(parts)
        read = re.split(rf"[^\w{JOINED}]+|[\d_]+", self.decode(run))
        return tuple(w.replace(JOINED, "") for w in (part.strip(JOINED) for part in read) if JOINED in w)

    def join_plain(self, parts: list[str]) -> tuple[str, ...]:
        """What decoding finds in fragments with one path each: from its second letter on, a fragment does not depend on the space before it."""
        cost, joined = self.cost, [parts[0]]
        out = []
        for part in parts[1:]:
            one, two, three, four = symbol(joined[-1][-2]), symbol(joined[-1][-1]), symbol(part[0]), symbol(part[1])
            if SPACED + cost[one][two][three] + cost[two][three][four] < cost[one][two][0] + cost[0][0][three] + cost[0][three][four]:
                joined.append(part)
                continue
            if len(joined) > 1:
                out.append("".join(joined))
            joined = [part]
        if len(joined) > 1:
            out.append("".join(joined))
        return tuple(out)

    def apart(self, text: str) -> Iterator[str]:
        """The runs of fragments of at most three characters, with one space between them."""
        for run in _APART.findall(text):
            yield " ".join(run.split())

    def restore(self, text: str) -> Iterator[tuple[str, ...]]:
        """The restored words across the spaces of every run of fragments, then of every token."""
        text = text.lower()
        yield from filter(None, map(self.runs.__getitem__, self.apart(text)))
        yield from map(self.words.__getitem__, text.split())


def word_features(word: str) -> tuple[str, ...]:
    """A word and its beginnings, as inflected words share a stem."""
    return (word, *(word[:k] + "-" for k in (4, 5, 6) if len(word) > k))


@dataclass(frozen=True)
class Model:
    """All that scoring needs: SIZE^3 costs, at most FEATURES weights, four coefficients."""

    language: np.ndarray
    weights: dict[str, float]
    coefficients: tuple[float, ...]


class Spelling:
    """Whether a lattice can spell a feature: a trie of all features, walked along every path at once.

    A token whose lattice spells none has no evidence whatever path is cheapest, so it need not be decoded.
    """

    def __init__(self, features: dict[str, float]):
        self.root: dict = {}
        for feature in features:
            node = self.root
            for char in feature.removesuffix("-"):
                node = node.setdefault(char, {})
            node[""] = True

    def can(self, text: str) -> bool:
        nodes, at, size, last = [self.root], 0, len(text), ""
        while at < size:
            char = text[at]
            letter = not _ENDS.match(char)
            reached = []
            if letter:
                reached = [n[char] for n in nodes if char in n]
            else:
                # a kept sign or space ends a word, so another may begin
                reached.append(self.root)
                for stand in STANDS_FOR.get(char, ""):
                    reached += [n[stand] for n in nodes if stand in n]
            if any("" in n for n in reached):
                return True
            if char == last or not (char.isalpha() or char.isdigit()):
                # left out: what was reached before stays
                reached += nodes
            known = {id(n): n for n in reached}
            same = char == last and len(known) == len(nodes)
            nodes, last = list(known.values()), char
            at += 1
            if same or not nodes:
                # nothing changes in the rest of a run of one character, nor before the next sign where no path is left
                while at < size and (text[at] == char if nodes else not _ENDS.match(text[at])):
                    at += 1
                if not nodes:
                    last = text[at - 1]
        return False


class Evidence:
    """Toxic evidence of texts: the sum over distinct words, the number of hits and their share."""

    def __init__(self, language: np.ndarray, weights: dict[str, float]):
        self.restorer = Restorer(language)
        self.weights = weights
        self.spelling = Spelling(weights)
        self.tokens = Memo(self.of_token, MEMO // 2)
        self.runs = Memo(lambda run: self.weigh(self.restorer.join(run)) if self.spelling.can(run) else (), MEMO // 4)

    def of_token(self, token: str) -> tuple:
        bare, word = self.restorer.plain(token)
        if word:
            return self.weigh((word,))
        return self.weigh(self.restorer.decoded(bare)) if self.spelling.can(bare) else ()

    def weigh(self, words: tuple[str, ...]) -> tuple:
        """() for most words, else the words and their weight: what is remembered of a token stays small."""
        weight = max((self.weights.get(f, 0.0) for w in words for f in word_features(w)), default=0.0)
        return (words, weight) if weight else ()

    def measure(self, text: str | None) -> tuple[float, float, float]:
        if not text:
            return 0.0, 0.0, 0.0
        text = text.lower()
        tokens = text.split()
        hits = [h for h in map(self.tokens.__getitem__, tokens) if h]
        hits += [h for run in self.restorer.apart(text) if (h := self.runs[run])]
        found = dict(hits)
        return float(np.log1p(sum(found.values()))), float(np.log1p(len(hits))), min(1.0, 10.0 * len(hits) / max(1, len(tokens)))


def fold(doc_id: Column) -> Column:
    """crc32 of the id as text, modulo five; a null id is in no fold."""
    return F.crc32(doc_id.cast("string").cast("binary")) % FOLDS


def labelled_sample(docs: DataFrame, labels: DataFrame, rows: int) -> DataFrame:
    """About ``rows`` labelled documents outside fold 0 at most, the same in every run; (text, toxic, fold).

    Of several labels of an id the largest holds.  Where ids repeat, so that more documents than that are
    labelled, documents are chosen by a hash of id and text, and equal ones count once.
    """
    known = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    known = known.filter(F.col("toxic").isin(0, 1) & (fold(F.col("doc_id")) != 0)).groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(rows)
    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"))
    # the limit bounds the side that is broadcast
    picked = texts.join(F.broadcast(chosen), "doc_id")
    found = texts.select("doc_id").join(F.broadcast(chosen), "doc_id").count()
    if found > rows:
        picked = picked.filter(F.pmod(F.xxhash64("doc_id", "text"), F.lit(1 << 30)) < int((1 << 30) * rows / found)).dropDuplicates(["doc_id", "text"])
    return picked.select("text", "toxic", fold(F.col("doc_id")).alias("fold"))


def feature_weights(sample: DataFrame, language: np.ndarray) -> dict[str, float]:
    """Log-odds of features of restored words, from texts of folds 1 to 3.

    Texts that share their smallest three-word hash count once, so that words of one much copied text
    do not look like words of many.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        restorer = Restorer(language)
        counts: dict[str, list[int]] = {}
        for batch in batches:
            for text, toxic in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                for feature in {f for words in restorer.restore(text) for w in words for f in word_features(w)}:
                    counts.setdefault(feature, [0, 0])[toxic] += 1
        yield pa.RecordBatch.from_arrays(
            [pa.array(counts, pa.string()), pa.array([c[0] for c in counts.values()], pa.int64()), pa.array([c[1] for c in counts.values()], pa.int64())],
            names=["feature", "clean", "toxic"],
        )

    split = sample.filter("fold < 4").select("text", "toxic", F.split(F.lower("text"), r"\s+").alias("words"))
    places = F.sequence(F.lit(0), F.greatest(F.size("words") - 3, F.lit(0)))
    smallest = F.array_min(F.transform(places, lambda i: F.xxhash64(*[F.get("words", i + k) for k in range(3)])))
    texts = split.groupBy(smallest.alias("like")).agg(F.min("text").alias("text"), F.max("toxic").alias("toxic")).select("text", "toxic")
    sizes = {r["toxic"]: r["n"] for r in texts.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    clean, toxic = sizes.get(0, 0), sizes.get(1, 0)
    if not toxic:
        return {}
    counts = texts.mapInArrow(run, "feature string, clean long, toxic long").groupBy("feature").agg(F.sum("clean").alias("clean"), F.sum("toxic").alias("toxic"))
    # two pseudo-texts at the common rate keep rare features from weighing much
    prior = 2 * toxic / (clean + toxic)
    weight = F.log((F.col("toxic") + prior) / (toxic + 2)) - F.log((F.col("clean") + 2 - prior) / (clean + 2))
    best = counts.filter(F.col("toxic") >= LEAST_TEXTS).select("feature", weight.alias("weight")).filter(F.col("weight") >= LEAST_WEIGHT)
    return {r["feature"]: r["weight"] for r in best.orderBy(F.desc("weight"), "feature").limit(FEATURES).collect()}


def fitted(x: np.ndarray, y: np.ndarray, rounds: int = 50, ridge: float = 0.05) -> np.ndarray:
    """Logistic regression by Newton steps; the intercept is the first coefficient."""
    x = np.column_stack([np.ones(len(x)), x])
    beta = np.zeros(x.shape[1])
    penalty = ridge * np.diag([0.0] + [1.0] * (x.shape[1] - 1))
    for _ in range(rounds):
        p = 1 / (1 + np.exp(-np.clip(x @ beta, -30, 30)))
        step = np.linalg.solve((x * (p * (1 - p) + 1e-6)[:, None]).T @ x + penalty, x.T @ (y - p) - penalty @ beta)
        beta += np.clip(step, -5, 5)
        if np.abs(step).max() < 1e-8:
            break
    return beta


def learn(docs: DataFrame, labels: DataFrame, rows: int = LABELLED_ROWS) -> Model:
    """The language model of all texts and a classifier of at most ``rows`` labelled ones, never of fold 0.

    Without toxic labels every text scores the share of toxic ones with one pseudo-count: low.
    """
    language = language_model(docs)
    sample = labelled_sample(docs, labels, rows)
    weights = feature_weights(sample, language)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        evidence = Evidence(language, weights)
        for batch in batches:
            measured = [evidence.measure(text) for text in batch.column(0).to_pylist()]
            columns = list(zip(*measured, strict=True)) or [()] * 3
            yield pa.RecordBatch.from_arrays([batch.column(1), *(pa.array(c, pa.float64()) for c in columns)], names=["toxic", "total", "hits", "share"])

    rest = sample.filter("fold = 4").select("text", "toxic").mapInArrow(run, "toxic int, total double, hits double, share double")
    # as many rows as the sample has; their order must not change the sums of the fit
    seen = np.array(sorted(tuple(r) for r in rest.collect()), dtype=float).reshape(-1, 4)
    # two pseudo-rows keep a table with one label, or none, solvable
    x = np.vstack([seen[:, 1:], [[0.0, 0.0, 0.0], [3.0, 3.0, 1.0]]])
    y = np.concatenate([seen[:, 0], [0.0, 1.0]])
    return Model(language, weights, tuple(fitted(x, y)))


def score_column(spark: SparkSession, model: Model, text: str = "text") -> Column:
    """The score of a text column, 0 to 1; null texts score as empty ones."""
    shared = spark.sparkContext.broadcast(model)

    @F.pandas_udf("double")
    def score(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        model = shared.value
        evidence = Evidence(model.language, model.weights)
        beta = np.array(model.coefficients)
        for texts in batches:
            x = np.array([(1.0, *evidence.measure(t)) for t in texts], dtype=float).reshape(-1, 4)
            yield pd.Series(1 / (1 + np.exp(-np.clip(x @ beta, -30, 30))))

    return score(F.col(text).cast("string"))


def score_documents(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document.

    Equal texts score alike, whatever their other columns.  A null or empty text scores like a text without
    evidence.  A null doc_id is held out of nothing.  An empty table gives no rows.
    """
    model = learn(docs, labels)
    scored = docs.select(F.col("doc_id").cast("long").alias("doc_id"), score_column(docs.sparkSession, model).alias("score"))
    return scored.select("doc_id", F.coalesce(fold(F.col("doc_id")) == 0, F.lit(False)).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))


def keep_clean(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """The documents that are not toxic, with their columns as they were."""
    model = learn(docs, labels)
    row = F.struct(*[F.col(f"`{c}`") for c in docs.columns])
    scored = docs.select(row.alias("row"), score_column(docs.sparkSession, model).alias("score"))
    return scored.filter("score < 0.5").select("row.*")
