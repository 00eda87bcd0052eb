"""Jaccard join with rows that share a doc_id or have none."""

import collections
import itertools
import random

import numpy as np
import pytest

from pricelift.llm import jaccard
from pricelift.llm.common import ship


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def as_counter(df):
    return collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def edited(rng, words, share):
    words = list(words)
    for _ in range(int(len(words) * share)):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


def test_near_copies_without_or_under_one_id(spark, monkeypatch):
    """Texts are nodes by what they hold: shared and null ids in partitions of many cells lose no link and no text."""
    monkeypatch.setattr(jaccard, "CELL_SETS", 10)
    rng = random.Random(21)
    bases = [[f"b{k}w{n}" for n in range(rng.choice([40, 120]))] for k in range(3)]
    texts = [" ".join(edited(rng, rng.choice(bases), rng.choice([0, 0.01, 0.02]))) for _ in range(150)]
    ids = [rng.choice([None, n % 40, n + 1000]) for n in range(len(texts))]
    rows = list(zip(ids, texts, strict=True)) + [(None, "a b c d e f g")] * 3 + [(7, "a b c d e f g h i j k l m")] * 2
    docs = spark.createDataFrame([(n, *row) for n, row in enumerate(rows)], "row long, doc_id long, text string").repartition(5)
    for size, percent in ((3, 90), (5, 80)):
        sets = [(n, jaccard.shingle_set(text, size)) for n, (_, text) in enumerate(rows)]
        forest = jaccard.Forest(len(rows))
        for n, m in itertools.combinations(range(len(rows)), 2):
            if jaccard.links(len(np.intersect1d(sets[n][1], sets[m][1])), len(sets[n][1]), len(sets[m][1]), percent):
                forest.join(n, m)
        label = forest.labels().tolist()
        smallest = {c: min((rows[n][0] for n in range(len(rows)) if label[n] == c and rows[n][0] is not None), default=None) for c in label}
        wanted = collections.Counter((i, len(sets[n][1]), None if i is None else smallest[label[n]]) for n, (i, _) in enumerate(rows))
        assert as_counter(jaccard.jaccard_components(docs, size, percent)) == wanted
        kept = jaccard.drop_near_duplicates(docs, size, percent).collect()
        assert sorted(label[r.row] for r in kept) == sorted(set(label))
        assert all(r.doc_id == smallest[label[r.row]] for r in kept)


def test_near_duplicates_of_odd_rows(spark):
    rows = [(None, "one two three four five six")] * 3 + [(5, "one two three four five six"), (6, None), (6, ""), (7, " "), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "'x' as mark", "1 as head", "2 as id", "3 as m")
    kept = jaccard.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == ["5", "6", "7", "None"]
    assert jaccard.drop_near_duplicates(docs.limit(0)).count() == 0


def test_rows_are_dealt_over_more_than_a_thousand_partitions():
    assert len(np.unique(jaccard.dealt(0, 50_000))) > 49_000


def chained(spark, n):
    """Unrelated texts of two passages each, which some other texts have too, so that keys chain most to one partition; and a near copy of every eighth."""
    rng = random.Random(3)
    passages = [[f"p{k}w{i}" for i in range(70)] for k in range(n // 2)]
    texts = [[*one, *(f"t{k}w{i}" for i in range(40)), *two] for k in range(n) for one, two in [rng.sample(passages, 2)]]
    texts += [edited(rng, texts[k], 0.01) for k in range(0, n, 8)]
    return spark.createDataFrame([(k, " ".join(t)) for k, t in enumerate(texts)], "doc_id long, text string")


def test_chained_texts_meet_by_key_and_not_all(spark, monkeypatch):
    """Every cell of a large partition was compared with every other, so bitmaps sent grew with the square of the table."""
    monkeypatch.setattr(jaccard, "CELL_SETS", 8)
    sent, solve = [], jaccard.task_edges

    def counted(members, percent, exact):
        if not exact:
            sent[-1] += members.count()
        return solve(members, percent, exact)

    monkeypatch.setattr(jaccard, "task_edges", counted)
    for n in (64, 256):
        sent.append(0)
        got = {r.doc_id: r.component_id for r in jaccard.jaccard_components(chained(spark, n), 5, 80).collect()}
        assert got == {k: k for k in range(n)} | {n + m: 8 * m for m in range(n // 8)}
    assert sent[0] and sent[1] < 6 * sent[0]


def test_keys_with_the_same_sets_are_compared_once(spark):
    """Keys 1 and 2 have the same sets, 3 has one more, 4 one that is not in the partition."""
    edges = spark.createDataFrame([(11, 10, 1), (11, 10, 2), (11, 10, 3), (12, 10, 3), (11, 99, 4)], "a long, b long, d long")
    large = spark.createDataFrame([(10, 0, 5), (11, 1, 6), (12, 2, 7)], "c long, node long, n long")
    got = sorted(tuple(r) for r in jaccard.sharing(edges, large).select("part", "node", "n").collect())
    assert got == [(1, 0, 5), (1, 1, 6), (3, 0, 5), (3, 1, 6), (3, 2, 7)]


def test_few_and_many_bitmaps_give_the_same_components():
    rng = np.random.default_rng(5)
    base = np.unique(rng.integers(0, 2**63, 200).astype(np.uint64))
    sets = [np.unique(np.concatenate([base[k // 4 * 40 : k // 4 * 40 + 40 - k % 4], rng.integers(0, 2**63, 2 * (k % 3)).astype(np.uint64)])) for k in range(16)]
    for chosen in ([0, 1, 2, 3], [0, 5, 1, 9, 6], list(range(8))):
        words, sizes = [jaccard.bitmap(sets[k], jaccard.width(len(sets[k]))) for k in chosen], [len(sets[k]) for k in chosen]
        matrix = np.array(words)
        few, tree = jaccard.Forest(len(chosen)), jaccard.Forest(len(chosen))
        for x, y in jaccard.possible_pairs(words, sizes, None, 80):
            few.join(x, y)
        for x, y in jaccard.traversed(matrix, np.array(sizes), matrix[:, 0], None, 80, None)[0]:
            tree.join(x, y)
        assert few.labels().tolist() == tree.labels().tolist()
