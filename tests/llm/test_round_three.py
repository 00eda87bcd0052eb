"""Merkle manifest, factorisation machine and periodic runs: brute force, SQL, held-out accuracy and odd tables."""

import collections
import hashlib
import random
import time
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from pricelift.llm import factorisation, html_text, merkle, packing, periodic, queries, toxicity
from pricelift.llm.common import ship, table

TINY = "/root/testdata/sf0.001"
SMALL_SF = "/root/testdata/sf0.01"
LONG = " ".join(f"w{n % 977}x{n % 31}" for n in range(40_000))
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (5, "one two"), (6, LONG), (7, LONG), (None, "a b c d"), (8, "é É ß 漢字 \U0001f600"),
    (4, "one two"), (9, "x y " * 40), (-3, "one  TWO"), (None, "a b c d"), (None, None),
]
CLASHING = ["row", "words", "tree", "at", "part", "number", "place", "block", "height", "id", "digest", "changed", "apart", "runs", "collapsed", "best", "score", "y", "draw", "found", "root", "leaf"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


@pytest.fixture(scope="module")
def odd(spark):
    plain = spark.createDataFrame(ODD, "doc_id long, text string")
    known = {"lang": F.when(F.col("doc_id") > 4, "en").when(F.col("doc_id") < 3, "é"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")}
    return plain.withColumns(known).select("*", *[F.lit(n).alias(c) for n, c in enumerate(CLASHING)])


# ------------------------------------------------------------------ 11 Merkle manifest

def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def brute_manifest(rows, changed_rows):
    """The contract, one row after another: (doc_id, leaf, subroot, root, proof digest, folded root, verified)."""
    field = lambda v: "-" if v is None else f"{len(str(v).encode())}:{v}"
    leaf = lambda r: h(*(field(r[c]) for c in ("doc_id", "source", "lang", "n_chars", "text")))

    def levels(leaves):
        out = [leaves]
        while len(out[-1]) > 1:
            out.append([h(*out[-1][n : n + 2]) for n in range(0, len(out[-1]), 2)])
        return out

    def way(tree, at):
        out = []
        for level in tree[:-1]:
            run = level[at // 2 * 2 : at // 2 * 2 + 2]
            out.append((run[:], at % 2))
            at //= 2
        return out

    groups = collections.defaultdict(list)
    for row, other in zip(rows, changed_rows, strict=True):
        groups[row["lang"]].append((row, leaf(row), leaf(other)))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {}
    for lang in order:
        groups[lang].sort(key=lambda t: (t[0]["doc_id"] is not None, t[0]["doc_id"] or 0, t[1]))
        trees[lang] = levels([t[1] for t in groups[lang]])
    upper = levels([trees[lang][-1][0] for lang in order])
    root, out = upper[-1][0], []
    for place, lang in enumerate(order):
        for at, (row, own, other) in enumerate(groups[lang]):
            steps = way(trees[lang], at) + way(upper, place)
            proof, folded = [], other
            for run, side in steps:
                proof += [d for n, d in enumerate(run) if n != side]
                run[side] = folded
                folded = h(*run)
            out.append((row["doc_id"], own, trees[lang][-1][0], root, h(*proof), folded, folded == root))
    return collections.Counter(out)


def changed(row):
    touched = row["doc_id"] is not None and zlib.crc32(str(row["doc_id"]).encode()) % 7 == 0 and row["n_chars"] is not None
    return row | {"n_chars": row["n_chars"] + 1} if touched else row


def as_rows(df):
    return [r.asDict() for r in df.select("doc_id", "source", "lang", "n_chars", "text").collect()]


@pytest.mark.parametrize("deep", [1, 2, 10])
def test_manifest_matches_brute_force(spark, deep):
    docs = table(spark, TINY, "documents")
    rows = as_rows(docs)
    got = collections.Counter(tuple(r) for r in merkle.manifest_digests(docs, deep).collect())
    assert got == brute_manifest(rows, [changed(r) for r in rows])


@pytest.mark.parametrize("deep", [2, 10])
def test_manifest_odd_table(spark, odd, deep):
    rows = as_rows(odd)
    got = collections.Counter(tuple(r) for r in merkle.manifest_digests(odd, deep).collect())
    assert got == brute_manifest(rows, [changed(r) for r in rows])
    assert merkle.manifest_digests(odd.limit(0)).count() == 0
    lone = odd.filter("doc_id = 8")
    (row,) = merkle.manifest_digests(lone).collect()
    assert row.leaf == row.subroot == row.root and row.proof_sha256 == h() and row.verified


def test_manifest_of_repeated_rows_and_many_languages(spark):
    base = spark.range(300).select(
        F.when(F.col("id") % 3 != 0, F.lit(14)).otherwise(F.col("id")).alias("doc_id"), F.lit("t").alias("text"), F.lit("s").alias("source"),
        F.when(F.col("id") % 5 != 0, F.concat(F.lit("l"), (F.col("id") % 17).cast("string"))).alias("lang"), F.lit(3).alias("n_chars"))
    rows = as_rows(base)
    got = collections.Counter(tuple(r) for r in merkle.manifest_digests(base, 2).collect())
    assert got == brute_manifest(rows, [changed(r) for r in rows])


def test_versions_share_what_they_do_not_touch():
    leaves = [h(str(n)) for n in range(13)]
    tree = merkle.PersistentTree(leaves, 4)
    before = list(tree.digests), list(tree.left), list(tree.right)
    root, size = tree.root, len(tree.digests)
    for at in range(13):
        made = tree.version(at, h("new", str(at)))
        assert len(made) == 5 and len(tree.digests) == size + 5 * (at + 1)
        fresh = merkle.PersistentTree([h("new", str(at)) if n == at else leaf for n, leaf in enumerate(leaves)], 4)
        assert tree.digests[made[-1]] == fresh.digests[fresh.root]
        assert merkle.climb(leaves[at], tree.siblings(at))[-1] == tree.digests[root]
    # a version copies the ancestors of one leaf and shares every other node
    assert (tree.digests[:size], tree.left[:size], tree.right[:size]) == before and tree.root == root


def test_manifest_general_outputs(spark):
    docs = table(spark, TINY, "documents").limit(50)
    for r in merkle.manifest(docs, {"text": F.lit("other")}, F.col("doc_id") % 2 == 0).collect():
        assert (r.copied is not None) == (r.doc_id % 2 == 0) and (r.folded_root == r.root) == (r.doc_id % 2 == 1)
        assert r.copied is None or r.copied[-1] == r.folded_root
    assert all(r.folded_root == r.root and r.copied is None for r in merkle.manifest(docs).collect())


# ------------------------------------------------------------------ 12 quality classifier

def test_quality_held_out(spark):
    got = queries.op12_quality_classifier(spark, SMALL_SF).join(table(spark, SMALL_SF, "labels"), "doc_id").toPandas()
    assert ((got.score >= 0) & (got.score <= 1)).all() and (got.predicted == (got.score >= 0.3)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    good, bad = held[held.quality == 1].score.to_numpy(), held[held.quality == 0].score.to_numpy()
    assert (good >= 0.3).mean() > 0.97 and (good[:, None] > bad[None]).mean() > 0.97


def test_quality_ignores_what_is_no_input(spark):
    docs, labels = table(spark, TINY, "documents"), table(spark, TINY, "labels")
    # same ids and labels, but other languages, sources and held-out labels
    other = docs.withColumns({"lang": F.lit("xx"), "source": F.lit(None).cast("string")})
    flipped = labels.withColumn("quality", F.when(factorisation.fold(F.col("doc_id")) == 0, 1 - F.col("quality")).otherwise(F.col("quality")))
    assert sorted(factorisation.score_documents(docs, labels).collect()) == sorted(factorisation.score_documents(other, flipped).collect())


def test_score_is_the_sum_over_pairs():
    rng = np.random.default_rng(3)
    size = factorisation.BUCKETS + len(factorisation.STATISTICS) * (factorisation.BINS + 1)
    machine = factorisation.Machine(np.zeros((len(factorisation.STATISTICS), factorisation.BINS - 1)), 0.3, rng.normal(size=size) * 0.1, rng.normal(size=(size, 8)) * 0.1)
    found, weights = np.array([3, 77, 4000]), np.array([0.2, 0.5, 0.1])
    bins = machine.bins(np.array([[np.nan] * 5 + [0.5] * (len(factorisation.STATISTICS) - 5)]))[0]
    places, values = np.concatenate([found, bins]), np.concatenate([weights * factorisation.WORDS_WEIGHT, np.ones(len(bins))])
    z = 0.3 + values @ machine.weights[places]
    for i in range(len(places)):
        for j in range(i + 1, len(places)):
            z += values[i] * values[j] * (machine.vectors[places[i]] @ machine.vectors[places[j]])
    assert abs(machine.score(found, weights, bins, (machine.vectors**2).sum(1)) - 1 / (1 + np.exp(-z))) < 1e-12


def test_machine_learns_a_pair_no_single_feature_tells():
    rng = np.random.default_rng(5)
    rows, labels = [], []
    for _ in range(1500):
        a, b = rng.integers(0, 2, 2)
        rows.append((np.array([a, 2 + b]), np.array([0.7, 0.7], np.float32), [np.nan] * len(factorisation.STATISTICS)))
        labels.append(float(a == b))
    machine = factorisation.fitted(rows, np.array(labels))
    squares, bins = (machine.vectors**2).sum(1), machine.bins(np.full((1, len(factorisation.STATISTICS)), np.nan))[0]
    right = [(machine.score(f, w, bins, squares) >= 0.5) == y for (f, w, _), y in zip(rows, labels, strict=True)]
    assert np.mean(right) > 0.99


def test_quality_odd_tables(spark, odd):
    labels = spark.createDataFrame([(n, n % 2) for n in range(1, 10)] + [(4, 0), (None, 1), (5, None)], "doc_id long, quality int")
    got = factorisation.score_documents(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert not any(r.held_out for r in got if r.doc_id is None)
    assert len({r.score for r in got if r.doc_id in (4, 5)}) == 1
    assert factorisation.score_documents(odd.limit(0), labels).count() == 0
    assert {r.score for r in factorisation.score_documents(odd, labels.limit(0)).collect()} == {0.5}
    assert factorisation.score_documents(odd.drop("n_chars"), labels).count() == len(ODD)
    rows, marks = factorisation.labelled_features(odd.union(odd).union(odd), labels, "quality", 6)
    assert len(rows) == len(marks) == 6


# ------------------------------------------------------------------ 13 periodic runs

def brute_runs(words, least):
    """All maximal stretches with a period, straight from the definition."""
    out, n = [], len(words)
    for q in range(1, n // 2 + 1):
        at = 0
        while at + q < n:
            stop = at
            while stop + q < n and words[stop] == words[stop + q]:
                stop += 1
            length = stop - at + q
            own = stop > at and length >= max(least, 2 * q)
            if own and not any(all(words[at + k] == words[at + k + r] for k in range(length - r)) for r in range(1, q)):
                out.append((at, length, q))
            at = stop + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


@pytest.mark.parametrize("least", [2, 4, 12])
def test_runs_match_brute_force(least):
    rng = random.Random(least)
    for _ in range(600):
        words = [b"%d" % rng.randrange(rng.choice([1, 2, 3, 6])) for _ in range(rng.randrange(70))]
        if words and rng.random() < 0.5:
            a = rng.randrange(len(words))
            p = 1 + (len(words) - a) // rng.randrange(2, 9)
            words = [w if n < a else words[a + (n - a) % p] for n, w in enumerate(words)]
        assert [tuple(r) for r in periodic.runs_of(words, least).tolist()] == brute_runs(words, least)


def test_extensions_match_letter_by_letter():
    rng = random.Random(9)
    for _ in range(60):
        text = [rng.randrange(1, 4) for _ in range(rng.randrange(2, 40))]
        tree = periodic.SuffixTree(text)
        closed = [*text, 0]
        suffixes = sorted(range(len(closed)), key=lambda n: closed[n:])
        assert tree.rank.tolist() == [suffixes.index(n) for n in range(len(closed))]
        turned = sorted(range(len(closed)), key=lambda n: [-c if c else -9 for c in closed[n:]])
        assert tree.opposite_rank().tolist() == [turned.index(n) for n in range(len(closed))]
        a, b = np.array([(x, y) for x in range(len(closed)) for y in range(len(closed)) if x != y]).T
        for x, y, found in zip(a.tolist(), b.tolist(), tree.extension(a, b).tolist(), strict=True):
            k = 0
            while max(x, y) + k < len(closed) and closed[x + k] == closed[y + k]:
                k += 1
            assert found == k


def brute_digests(doc_id, text):
    words = periodic.planted_tail(doc_id, (text or "").encode().split())
    runs = brute_runs(words, 12)
    drop = {n for s, length, q in runs for n in range(s + q, s + length)}
    best = min(runs, key=lambda r: (-r[1], r[0], r[2]), default=(None,) * 3)
    sha = lambda body: hashlib.sha256(body).hexdigest()
    return (
        doc_id, len(runs), *best, 1000 * best[1] // best[2] if runs else None, sha("".join("%d,%d,%d\n" % r for r in runs).encode()),
        sha(b" ".join(w for n, w in enumerate(words) if n not in drop)),
    )


def test_run_digests_match_brute_force(spark):
    docs = table(spark, TINY, "documents").filter(F.length("text") < 6000)
    assert docs.count() > 100
    found = periodic.run_digests(periodic.find_runs(docs, edit=periodic.planted_tail)).collect()
    assert collections.Counter(map(tuple, found)) == collections.Counter(brute_digests(r.doc_id, r.text) for r in docs.collect())
    assert sum(r.n_runs > 0 for r in found) > 10


def test_runs_odd_tables(spark, odd):
    short = odd.filter("length(text) < 1000 or text is null")
    got = collections.Counter(map(tuple, periodic.run_digests(periodic.find_runs(short, edit=periodic.planted_tail)).collect()))
    assert got == collections.Counter(brute_digests(r.doc_id, r.text) for r in short.collect())
    long = spark.createDataFrame([(1, "a b c " * 60_000), (2, LONG), (3, "x " * 150_000), (4, "y" * 2_000_000)], "doc_id long, text string")
    runs = {r.doc_id: [tuple(x) for x in r.runs] for r in periodic.find_runs(long).collect()}
    assert runs[1] == [(0, 180_000, 3)] and runs[3] == [(0, 150_000, 1)] and runs[4] == []
    # w and x repeat together every 977 * 31 words: 40,000 words hold that once and a bit
    assert runs[2] == []
    assert periodic.find_runs(odd.limit(0)).count() == 0


def test_collapse_keeps_the_first_period_of_every_run():
    words = b"p a b a b a b a b a b a b q c c c c c c c c c c c c r".split()
    runs = periodic.runs_of(words)
    assert [tuple(r) for r in runs.tolist()] == [(1, 12, 2), (14, 12, 1)]
    assert periodic.collapse(words, runs) == b"p a b q c r".split()


# ------------------------------------------------------------------ texts that earlier operators could not take

FEATURES = {"idiot": 5.0, "idio-": 4.0, "trash": 5.0, "clow-": 4.0, "loser": 3.5, "scum": 6.0}


def test_toxic_spelling_finds_what_decoding_finds():
    rng = np.random.default_rng(8)
    evidence = toxicity.Evidence(np.log(rng.dirichlet(np.full(64, 0.4), (64, 64))).astype(np.float32), FEATURES)
    draw, words = random.Random(8), [f.removesuffix("-") for f in FEATURES]
    hits = 0
    for _ in range(4000):
        out = []
        for char in draw.choice(words) + draw.choice(["", "s", "ing"]):
            stands = [k for k, v in toxicity.STANDS_FOR.items() if char in v]
            chance = draw.random()
            out.append(draw.choice(stands) if chance < 0.3 and stands else char * draw.randrange(1, 4) if chance < 0.4 else char + draw.choice(".-_*=\u00bd\u00b2 ") if chance < 0.5 else char)
        text = draw.choice(["", "the ", "!!", "a b "]) + "".join(out) + draw.choice(["", "!", "***", " on", " x y"])
        for token in text.split():
            assert evidence.of_token(token) == evidence.weigh(evidence.restorer.read(token)), token
        for run in evidence.restorer.apart(text):
            assert evidence.runs[run] == evidence.weigh(evidence.restorer.join(run)), run
        hits += evidence.measure(text)[1] > 0
    assert 300 < hits < 4000


def test_toxic_evidence_of_long_runs_takes_little_time():
    rng = np.random.default_rng(8)
    evidence = toxicity.Evidence(np.log(rng.dirichlet(np.full(64, 0.4), (64, 64))).astype(np.float32), FEATURES)
    for text in ("a" + "=" * 1_000_000 + "b", "a" + "*" * 1_000_000 + "b", "=" * 1_000_000, "*" * 1_000_000 + " b", "a" * 1_000_000):
        start = time.time()
        assert evidence.measure(text) == (0.0, 0.0, 0.0)
        assert time.time() - start < 2
    # what is decoded after all is read in time in proportion to its length
    took = []
    for size in (5_000, 20_000):
        start = time.time()
        evidence.restorer.decode("a" + "=" * size + "b")
        took.append(time.time() - start)
    assert took[1] < 12 * took[0] + 0.05


def test_toxic_sample_is_bounded_and_has_one_label_an_id(spark):
    docs = spark.createDataFrame([(1, f"text {n}") for n in range(3000)] + [(n, "other") for n in range(2, 30)], "doc_id long, text string")
    labels = spark.createDataFrame([(1, 0), (1, 1), *((n, 0) for n in range(2, 30))], "doc_id long, toxic int")
    whole = toxicity.labelled_sample(docs, labels, 10_000)
    assert whole.filter("text like 'text%'").select("toxic").distinct().collect() == [(1,)]
    assert 300 < toxicity.labelled_sample(docs, labels, 500).count() < 700


@pytest.mark.parametrize("body", [" " * 1_000_000, "\n" * 1_000_000, "\t" * 1_000_000, " \n" * 500_000], ids=["blanks", "lines", "tabs", "both"])
def test_long_white_space_is_packed(body):
    from tokenizers import Tokenizer

    path = queries.vocabulary("byte_bpe_50k.json")
    peer, own = Tokenizer.from_file(path), packing.byte_encoder(path)
    ids = lambda text: np.frombuffer(own.encode(text), "<u4").tolist()
    for text in (f"a{body[:9000]}b", f"a{body[:9000]}", f"{body[:8999]}\u3000<|endoftext|>{body[:6000]}b c", f"x {body[:5000]}\x1c{body[:5000]}\u2003y"):
        assert ids(text) == peer.encode(text, add_special_tokens=False).ids
    for text in (f"a{body}b", body):
        assert own.encoder.decode(ids(text)) == text


def test_long_white_space_is_packed_by_spark(spark):
    docs = spark.createDataFrame([(1, " " * 1_000_000), (2, "a" + "\n" * 1_000_000 + "b"), (3, "c")], "doc_id long, text string")
    pieces = packing.pack_documents(docs, queries.vocabulary("byte_bpe_50k.json")).collect()
    assert {r.doc_id for r in pieces} == {1, 2, 3} and all(r.length <= 1024 for r in pieces)


def test_html_with_deep_and_unmatched_tags(spark):
    story = "<article><p>" + "a long story of words " * 20 + "</p></article>"
    bodies = ["<b>" * 100_000 + "</i>" * 100_000, "<div>" * 30_000 + "</span>" * 30_000, "<li>" * 50_000, "</p>" * 100_000]
    start = time.time()
    pages = spark.createDataFrame([(n, "u", body + story) for n, body in enumerate(bodies)], "page_id long, url string, html string")
    got = html_text.extract_pages(pages).collect()
    assert len(got) == 4 and all("a long story of words" in r.text for r in got) and time.time() - start < 30


# ------------------------------------------------------------------ hot keys

def test_slots_of_keys_with_one_remainder_are_spread(spark):
    from pricelift.llm import sharding

    docs = spark.range(20_000).select((F.col("id") * 4096).alias("doc_id"), F.lit("same").alias("text"))
    pieces = docs.select(sharding.slot_piece(F.col("doc_id"), F.crc32(F.col("text").cast("binary")), 4096).alias("p")).groupBy("p").count().collect()
    assert len(pieces) > 3500 and max(r["count"] for r in pieces) < 30
    got = sharding.shard_documents(docs).groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.count_distinct("slot").alias("d")).collect()
    assert sum(r.n for r in got) == 20_000 and all(r.lo == 0 and r.hi == r.n - 1 and r.d == r.n for r in got)


def test_slots_of_copies_are_gapless(spark):
    from pricelift.llm import sharding

    docs = spark.range(30_000).select(F.when(F.col("id") % 3 == 0, F.col("id")).when(F.col("id") % 3 == 1, F.lit(7)).alias("doc_id"), F.lit("same").alias("text"))
    got = sharding.shard_documents(docs)
    rows = got.groupBy("shard").agg(F.count("*").alias("n"), F.min("slot").alias("lo"), F.max("slot").alias("hi"), F.count_distinct("slot").alias("d")).collect()
    assert sum(r.n for r in rows) == 30_000 and all(r.lo == 0 and r.hi == r.n - 1 and r.d == r.n for r in rows)
    assert got.filter("doc_id = 7").count() == 10_000 and got.filter("doc_id is null").count() == 10_000


def test_equal_rows_are_dealt_to_many_packing_groups(spark):
    docs = spark.range(6_000).select(F.lit(None).cast("long").alias("doc_id"), F.lit("one two three").alias("text"))
    path = queries.vocabulary("byte_bpe_50k.json")
    rows = packing.pack_documents(docs, path, docs_per_group=500).select("sequence_id", "offset", "length").collect()
    groups = collections.Counter(r.sequence_id >> 32 for r in rows)
    assert len(rows) == 6_000 and len(groups) == 12 and max(groups.values()) < 700
    assert len({(r.sequence_id, r.offset) for r in rows}) == 6_000 and all(r.offset + r.length <= 1024 for r in rows)
