"""Corpus operators: SQL, brute force, exact round trips, held-out accuracy and odd tables."""

import collections
import gzip
import hashlib
import itertools
import math
import random
import re
import zlib

import duckdb
import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from oracle import connect, difference
from pricelift.llm import ann, bpe, components, html_text, jaccard, licenses, packing, quality, queries, sharding, sql, toxicity, warc
from pricelift.llm.common import scratch, ship, table

TINY = "/root/testdata/sf0.001"
SMALL_SF = "/root/testdata/sf0.01"
LONG = " ".join(f"w{n % 977}x{n % 31}" for n in range(40_000))
ODD = [
    (1, None), (2, ""), (3, "  \n\t "), (4, "one two"), (5, "one two"), (6, LONG), (7, LONG), (None, "a b c d"), (8, "é É ß 漢字 \U0001f600"),
    (4, "one two"), (9, "<|endoftext|> it's"), (-3, "one  TWO"),
]
#: Names that the operators use inside.
CLASHING = ["row", "words", "k", "a", "b", "c", "d", "node", "tasks", "score", "piece", "shard", "kept", "n", "rep", "part", "level", "like", "fold", "record_type"]


@pytest.fixture(scope="module", autouse=True)
def shipped(spark):
    ship(spark)


def clashing(df):
    return df.select("*", *[F.lit(n).alias(name) for n, name in enumerate(CLASHING)])


@pytest.fixture(scope="module")
def odd(spark):
    return clashing(spark.createDataFrame(ODD, "doc_id long, text string")).withColumns({"lang": F.lit("en"), "source": F.lit("s"), "n_chars": F.length("text").cast("long")})


@pytest.fixture(scope="module")
def labels(spark):
    return spark.createDataFrame([(n, 1, n % 2) for n in range(1, 10)], "doc_id long, quality int, toxic int")


def vocabulary(name):
    return queries.vocabulary(name)


@pytest.mark.parametrize("key", sorted(queries.oracle_sql()))
def test_query_matches_sql(spark, key):
    con = connect(TINY)
    assert difference(queries.queries()[key](spark, TINY), con, queries.oracle_sql()[key]) is None


# ------------------------------------------------------------------ 1 toxicity

def test_toxicity_held_out(spark):
    got = queries.op1_toxicity(spark, SMALL_SF).join(table(spark, SMALL_SF, "labels"), "doc_id").toPandas()
    assert ((got.score >= 0) & (got.score <= 1)).all() and (got.predicted == (got.score >= 0.5)).all()
    assert (got.held_out == [zlib.crc32(str(i).encode()) % 5 == 0 for i in got.doc_id]).all()
    held = got[got.held_out]
    assert (held.predicted == held.toxic).mean() > 0.93


def test_toxicity_restores(spark):
    model = toxicity.language_model(spark.createDataFrame([("you are an idiot and a stupid moron in the trash with a loser and a clown",)] * 50, "text string"))
    read = toxicity.Restorer(model)
    for noisy, plain in {"1d10t": "idiot", "m0r0n": "moron", "stuuuupid": "stupid", "tr@sh": "trash", "c.l.o.w.n": "clown", "idiot": "idiot"}.items():
        assert read.words[noisy] == (plain,), noisy
    assert ("idiot",) in list(read.restore("you are an i d i o t"))[:1] + list(read.restore("an i d i o t!"))


def test_toxicity_restores_edges_doubles_and_fragments(spark):
    text = "you are an idiot and a stupid moron in the trash with a loser and a clown"
    read = toxicity.Restorer(toxicity.language_model(spark.createDataFrame([(text,)] * 50, "text string")))
    noisy = {
        "!diot": "idiot", "|oser": "loser", "(lown": "clown", "<lown": "clown", "+rash": "trash", "idio+": "idiot", "idio+.": "idiot", "\"!diot\"": "idiot",
        "iddiot": "idiot", "looser": "loser", "mooron": "moron", "idiot!": "idiot", "idiot!!": "idiot", "(idiot)": "idiot", "idiot***": "idiot",
    }
    assert {n: read.words[n] for n in noisy} == {n: (plain,) for n, plain in noisy.items()}
    for text in ("an i d i o t", "an i  d\ti\n o  t!", "stupid id iot", "id iot!", "stupid idi ot trash"):
        assert any("idiot" in words for words in read.restore(text)), text
    assert list(read.restore("you are an idiot")) == [("you",), ("are",), ("an",), ("idiot",)]
    english = toxicity.Restorer(toxicity.language_model(spark.createDataFrame([("trass grass glass trash",)] * 50, "text string")))
    assert english.words["tra$$"] == ("trass",)


def test_toxicity_short_way_joins_as_decoding():
    rng = np.random.default_rng(4)
    read = toxicity.Restorer(np.log(rng.dirichlet(np.full(64, 0.3), (64, 64))).astype(np.float32))
    seen = set()
    for _ in range(500):
        parts = ["".join(rng.choice(list("abcdé"), rng.integers(2, 4), replace=False)) for _ in range(rng.integers(2, 6))]
        split = re.split(" ", read.decode(" ".join(parts)))
        assert read.join(" ".join(parts)) == tuple(w.replace(toxicity.JOINED, "") for w in split if toxicity.JOINED in w)
        seen.add(len(split) < len(parts))
    assert seen == {False, True}


def test_toxicity_viterbi_is_the_cheapest_path():
    rng = np.random.default_rng(2)
    read = toxicity.Restorer(np.log(rng.dirichlet(np.ones(64), (64, 64))).astype(np.float32))
    for token in ("a1b", "0o0", "s.s", "aa4", "$1"):
        best = math.inf, ""
        for path in itertools.product(*[read._readings(token, n, toxicity.at_edges(token)) for n in range(len(token))]):
            cost, state = 0.0, (0, 0)
            for char, price in path:
                cost += price
                if char:
                    cost += read.cost[state[0]][state[1]][toxicity.symbol(char)]
                    state = state[1], toxicity.symbol(char)
            cost += read.cost[state[0]][state[1]][0]
            best = min(best, (cost, "".join(c for c, _ in path)))
        assert read.decode(token) == best[1]


def test_toxicity_odd_tables(spark, odd, labels):
    got = toxicity.score_documents(odd, labels).collect()
    assert len(got) == len(ODD) and all(0 <= r.score <= 1 for r in got)
    assert len({r.score for r in got if r.doc_id in (1, 2, 3)}) == 1 and not any(r.held_out for r in got if r.doc_id is None)
    assert toxicity.score_documents(odd.limit(0), labels).count() == 0
    assert toxicity.score_documents(odd, labels.limit(0)).count() == len(ODD)
    assert toxicity.keep_clean(odd, labels.limit(0)).columns == odd.columns


# ------------------------------------------------------------------ 2 neighbours

def near_by_sql(df):
    con = duckdb.connect()
    con.register("embeddings", df)
    return con.sql(sql.ANN_SQL).fetchall()


def same_neighbours(got, expected):
    got, expected = ({(r[0], r[1]): (r[2], r[3]) for r in rows} for rows in (got, expected))
    assert got.keys() == expected.keys()
    assert all(got[k][0] == expected[k][0] and abs(got[k][1] - expected[k][1]) < 1e-12 for k in got)


def test_neighbours_match_brute_force(spark):
    found = [tuple(r) for r in queries.op2_ann(spark, TINY).collect()]
    same_neighbours(found, near_by_sql(table(spark, TINY, "embeddings").toPandas()))


def test_neighbours_odd_tables(spark):
    rng = random.Random(5)
    rows = [(n, [rng.gauss(0, 1) for _ in range(6)]) for n in range(120)] + [(n, [1.0, 2.0, 0.0, 0.0, 0.0, 1.0]) for n in range(200, 330)]
    rows += [(150, None), (350, []), (400, [0.0] * 6), (450, [1.0, None, 0.0, 0.0, 0.0, 0.0]), (500, [float("nan")] * 6), (550, [math.inf] * 6), (600, [1.0, 2.0]), (650, [2.0, 4.0]), (None, [1.0] * 6)]
    vectors = clashing(spark.createDataFrame(rows, "vec_id long, embedding array<float>"))
    found = [tuple(r) for r in ann.nearest(vectors).collect()]
    fine = [(i, np.array(v, np.float64)) for i, v in rows if i is not None and v and None not in v and np.isfinite(np.array(v, float)).all() and any(v)]
    expected = []
    for q, u in fine:
        if q % 50 == 0:
            near = sorted((-float(u.astype(np.float32).astype(float) @ w.astype(np.float32).astype(float) / math.sqrt(sum(np.float32(x).astype(float) ** 2 for x in u)) / math.sqrt(sum(np.float32(x).astype(float) ** 2 for x in w))), i) for i, w in fine if i != q and len(w) == len(u))
            expected += [(q, n + 1, i, -s) for n, (s, i) in enumerate(near[:5])]
    exact = {(r[0], r[1]): r for r in found}
    assert exact.keys() == {(r[0], r[1]) for r in expected}
    assert all(abs(exact[r[0], r[1]][3] - r[3]) < 1e-6 for r in expected)
    assert [exact[200, n][2] for n in range(1, 6)] == [201, 202, 203, 204, 205]
    assert ann.nearest(vectors.limit(0)).count() == 0


def test_quantisation_bound_holds():
    rng = np.random.default_rng(1)
    for dim in (1, 3, 64, 1500):
        a, b = rng.normal(size=(40, dim)).astype(np.float32), rng.normal(size=(50, dim)).astype(np.float32) ** 3
        (p, s), (q, t) = ann.quantised(a), ann.quantised(b)
        tile = ann.products(p, q) * s[:, 0, None] * t[None, :, 0]
        exact = np.array([[ann.cosines(a[i : i + 1], b[j : j + 1])[0] for j in range(50)] for i in range(40)])
        assert (np.abs(tile - exact) <= s[:, 1, None] + s[:, 2, None] * t[None, :, 1] + ann.SLACK).all()


# ------------------------------------------------------------------ 3 licences

def test_licence_variants(spark):
    mit = "MIT License\n\nCopyright (c) 2019 Some One\n\n" + licenses.KNOWN["MIT (grant)"].replace("sublicense", "sub-license").upper()
    rows = [(1, mit), (2, "x\nReleased under the MIT Licence!\ny"), (3, None), (4, ""), (5, mit + " more"), (1, mit), (6, LONG)]
    got = {r.doc_id: r for r in licenses.scan(clashing(spark.createDataFrame(rows, "doc_id long, text string"))).collect()}
    assert got[1].license == "MIT" and got[2].notices == "MIT (notice)" and got[2].license is None
    assert got[3].text_digest is None and got[4].text_digest is None and got[5].license is None
    assert licenses.scan(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def test_licence_full_texts_and_owners(spark):
    known = licenses.KNOWN
    mit = "MIT License\n\nCopyright {}\n\n" + known["MIT (grant)"]
    owners = ["The X Authors", "Jane Doe", "holdens ltd", "an owner", "by Some One", "H. Olders", "notary public", "(c) 2019 Y", "2020 Z"]
    full = ["Apache-2.0", "GPL-2.0", "GPL-3.0", "LGPL-2.1", "LGPL-3.0", "MPL-2.0", "CC0-1.0"]
    wrapped = {name: " ".join(known[name].split()) for name in ("MPL-2.0", "CC0-1.0")}
    rows = [(n, mit.format(o)) for n, o in enumerate(owners)] + [(100 + n, known[name]) for n, name in enumerate(full)]
    rows += [(200 + n, body) for n, body in enumerate(wrapped.values())] + [(300, known["Apache-2.0 (terms)"])]
    got = {r.doc_id: r.license for r in licenses.scan(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert [got[n] for n in range(len(owners))] == ["MIT"] * len(owners)
    assert [got[100 + n] for n in range(len(full))] == full
    assert [got[200 + n] for n in range(len(wrapped))] == list(wrapped) and got[300] == "Apache-2.0 (terms)"
    for line in ("copyright notice and this", "copyright holders be liable", "copyright law: that is", "copyrighted by x", "copyright-like laws"):
        assert not re.search(licenses.COPYRIGHT_LINES, line), line


# ------------------------------------------------------------------ 4 Jaccard join

def shingles(text, size):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + size]) for i in range(max(1, len(words) - size + 1)))


def brute_components(rows, size, percent):
    sets = [(i, shingles(t, size)) for i, t in rows if i is not None]
    index = collections.defaultdict(set)
    for n, (_, s) in enumerate(sets):
        for x in s:
            index[x].add(n)
    forest = jaccard.Forest(len(sets))
    for n, (_, s) in enumerate(sets):
        for m, overlap in collections.Counter(m for x in s for m in index[x] if m > n).items():
            if jaccard.links(overlap, len(s), len(sets[m][1]), percent):
                forest.join(n, m)
    smallest = {}
    for n, label in enumerate(forest.labels().tolist()):
        smallest[label] = min(smallest.get(label, math.inf), sets[n][0])
    return collections.Counter((sets[n][0], len(sets[n][1]), smallest[label]) for n, label in enumerate(forest.labels().tolist()))


def as_counter(df):
    return collections.Counter((r.doc_id, r.n_shingles, r.component_id) for r in df.collect())


def edited(rng, words, share):
    words = list(words)
    for _ in range(int(len(words) * share)):
        words[rng.randrange(len(words))] = f"new{rng.randrange(10**6)}"
    return words


@pytest.mark.parametrize(("size", "percent"), [(3, 90), (5, 80)])
def test_components_match_brute_force(spark, size, percent):
    docs = table(spark, TINY, "documents")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    assert as_counter(jaccard.jaccard_components(docs, size, percent)) == brute_components(rows, size, percent)


def test_components_of_large_groups(spark, monkeypatch):
    monkeypatch.setattr(jaccard, "CELL_SETS", 12)
    rng = random.Random(11)
    bases = [[f"b{k}w{n}" for n in range(rng.choice([8, 30, 120, 400]))] for k in range(4)]
    texts = [" ".join(edited(rng, rng.choice(bases), rng.choice([0, 0.005, 0.01, 0.02, 0.05]))) for _ in range(220)]
    texts += [" ".join(bases[2][: len(bases[2]) - k]) for k in range(40)]
    rows = list(enumerate(texts, 1))
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    for size, percent in ((3, 90), (5, 80)):
        assert as_counter(jaccard.jaccard_components(docs, size, percent)) == brute_components(rows, size, percent)


def test_components_odd_tables(spark, odd):
    got = [tuple(r) for r in jaccard.jaccard_components(odd).collect()]
    assert collections.Counter(r[0] for r in got) == collections.Counter(i for i, _ in ODD)
    of = {r[0]: r for r in got}
    assert of[1][1:] == of[1][1:] == (0, 1) and of[2][1:] == (0, 2) and of[None][2] is None
    assert of[4][2] == of[5][2] == of[-3][2] == -3 and of[6][2] == of[7][2] == 6
    assert jaccard.jaccard_components(odd.limit(0)).count() == 0
    kept = jaccard.drop_near_duplicates(odd)
    assert kept.columns == odd.columns and sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-3, 1, 2, 3, 6, 8, 9]


def test_slices_keep_every_linked_pair():
    rng = random.Random(3)
    for percent in (90, 80, 60):
        slices = jaccard.Slices(percent)
        for _ in range(400):
            n = rng.choice([1, 5, 9, 10, 20, 40, 100, 300]) + rng.randint(0, 3)
            base = [rng.getrandbits(64) for _ in range(n)]
            change = rng.randint(0, int((100 - percent) / (100 + percent) * 2 * n) + 1)
            out = rng.randint(0, change)
            a = np.unique(np.array(base, np.uint64))
            b = np.unique(np.array(base[out:] + [rng.getrandbits(64) for _ in range(change - out)] or [1], np.uint64))
            if jaccard.links(len(np.intersect1d(a, b)), len(a), len(b), percent):
                assert len(np.intersect1d(slices.keys(a), slices.keys(b)))


def test_connected_components(spark):
    rng = random.Random(7)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(n, n + 1) for n in range(1000, 1060)] + [(5, 5)]
    forest = jaccard.Forest(1100)
    for a, b in edges:
        forest.join(a, b)
    got = {r.node: r.component for r in components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {n: forest.find(n) for e in edges if e[0] != e[1] for n in e}


# ------------------------------------------------------------------ 5 HTML

def test_main_text():
    page = """<html><head><title>T</title><style>p{}</style><script>var a="</p>";</script></head><body><nav><ul><li><a href=x>Home</a></ul></nav>
    <div class="cookie-notice">We use cookies</div><article><h1>Head &amp; line</h1><p>One <b>bold</b>
      text.<br>Second<p>Caf&eacute; &lt;x&gt; <button>Share</button>end<aside>Related</aside><div class="comments"><p>First!</p></div></article>
    <footer>&copy; me</footer></body></html>"""
    assert html_text.main_text(page) == "Head & line\nOne bold text. Second\nCafé <x> end"
    assert html_text.main_text(None) == html_text.main_text("") == html_text.main_text("<nav>x</nav>") == ""
    assert html_text.main_text("just text") == "just text"
    framed = '<div class="site-header">Site</div><div id="main"><div style="display: none">x</div><article><div class="article-header"><h1>H</h1></div><p>B</article></div>'
    assert html_text.main_text(framed) == "H\nB"
    plain = "<div>" + "".join(f"<a href=x>l{n}</a> " for n in range(9)) + "</div><p>" + "long text here " * 20 + "</p><p>short.</p><p>" + "more text here " * 20 + "</p><div><a>x</a><a>y</a></div>"
    assert html_text.main_text(plain).split("\n")[1] == "short." and "l0" not in html_text.main_text(plain)


def test_main_text_cuts_inside_an_article():
    story = [f"<p>{'long story text ' * 15}{n}.</p>" for n in range(6)]
    links = "<ul>" + "".join(f"<li><a href=/{n}>elsewhere {n}</a></li>" for n in range(7)) + "</ul>"
    items = "<ul><li>Eggs</li><li>Milk</li><li>Flour</li><li>Salt</li></ul>"
    head = "<h1><a href=/self>Head</a></h1>"
    for tag in ("article", "main"):
        got = html_text.main_text(f"<{tag}>{head}{story[0]}{links}{story[1]}{items}<p>Yes.</p>{links}</{tag}>")
        assert "elsewhere" not in got
        lines = got.split("\n")
        assert lines[0] == "Head" and lines[1].endswith("0.") and lines[2].endswith("1.") and lines[3:] == ["Eggs", "Milk", "Flour", "Salt", "Yes."]
    # a short article among long ones keeps its text
    assert "brief" in html_text.main_text(f"<article>{''.join(story)}</article><article><h2>Next</h2><p>{'a brief post ' * 12}</p></article>")


def test_main_text_next_to_a_teaser():
    story = "".join(f"<p>{'long story text ' * 15}{n}.</p>" for n in range(6))
    teaser = "<article><h3><a href=/x>Other</a></h3><p>Short teaser.</p></article>"
    got = html_text.main_text(f"<div><h1>Head</h1>{story}</div>{teaser}")
    assert all(f"{n}." in got for n in range(6)) and "teaser" not in got
    # a notice outside does not outweigh an article
    assert "notice" not in html_text.main_text(f"<p>{'a notice ' * 20}</p><article>{story}</article>")


def test_pages(spark):
    for r in queries.op5_html_text(spark, TINY).join(table(spark, TINY, "pages").select("page_id", "html"), "page_id").collect():
        inside = re.search(r"<article>(.*?)</article>", r.html, re.S)[1]
        expected = " ".join(__import__("html").unescape(re.sub(r"<(?:/?[a-zA-Z][^>]*|!--.*?--)>", " ", inside)).split())
        assert r.text.replace("\n", "").replace(" ", "") == expected.replace(" ", "") and r.n_chars == len(r.text)
    rows = spark.createDataFrame([(1, "u", None), (1, "u", ""), (None, None, "<p>x"), (2, "u", "<p>" * 50_000 + "deep")], "page_id long, url string, html string")
    assert sorted(r.text for r in html_text.extract_pages(clashing(rows)).collect()) == ["", "", "deep", "x"]


# ------------------------------------------------------------------ 6 packing

def checked_packing(rows, packed, size=1024):
    from tokenizers import Tokenizer

    tokenizer = Tokenizer.from_file(vocabulary("byte_bpe_50k.json"))
    tokenizer.no_truncation()
    tokenizer.no_padding()
    expected = collections.Counter()
    for doc_id, text in rows:
        ids = tokenizer.encode(text or "", add_special_tokens=False).ids + [2]
        first = len(ids) % size or min(size, len(ids))
        cuts = [0, *range(first, len(ids) + 1, size)]
        for n, (a, b) in enumerate(itertools.pairwise(cuts)):
            expected[doc_id, n, a, b - a, zlib.crc32(np.array(ids[a:b], "<u4").tobytes())] += 1
    assert collections.Counter((r.doc_id, r.piece, r.start, r.length, r.ids_crc32) for r in packed) == expected
    places = collections.defaultdict(list)
    for r in packed:
        places[r.sequence_id].append((r.offset, r.length))
    for own in places.values():
        at = 0
        for offset, length in sorted(own):
            assert offset == at
            at += length
        assert at <= size
    return len(places), math.ceil(sum(r.length for r in packed) / size)


def test_packing(spark, odd):
    docs = table(spark, TINY, "documents")
    used, least = checked_packing([(r.doc_id, r.text) for r in docs.collect()], queries.op6_packing(spark, TINY).collect())
    assert used <= least * 1.05
    checked_packing(ODD, packing.pack_documents(odd, vocabulary("byte_bpe_50k.json"), docs_per_group=5).collect())
    assert packing.pack_documents(odd.limit(0), vocabulary("byte_bpe_50k.json")).count() == 0


def test_best_two_fit_replaces_the_smallest():
    # greedy puts 6 and 3 into the first bin; 2 + 2 fill the place of 3 exactly
    assert packing.best_two_fit(np.array([6, 3, 2, 2]), 10) == [[6, 2, 2], [3]]
    rng = np.random.default_rng(3)
    lengths = rng.integers(1, 1024, 5000)
    bins = packing.best_two_fit(lengths, 1024)
    assert sorted(itertools.chain(*bins)) == sorted(lengths.tolist()) and max(map(sum, bins)) <= 1024
    assert len(bins) <= math.ceil(lengths.sum() / 1024) * 1.01


# ------------------------------------------------------------------ 7 WARC

def test_archives(spark, odd):
    body = "<p>" + "x" * 1200
    rows = [(1, "u", body), (2, "u\r\nv", body), (3, None, "short"), (4, "u", "short"), (5, "u", None), (None, "u", body), (6, "é" * 600, "é" * 600), (6, "u", "é" * 600)]
    pages = clashing(spark.createDataFrame(rows, "page_id long, url string, html string"))
    path = scratch(spark, "warc-test")
    got = collections.Counter(tuple(r) for r in warc.round_trip(pages, path).collect())
    sha = lambda t: hashlib.sha1((t or "").encode()).hexdigest()
    assert got == collections.Counter([
        (1, 1203, sha(body), "revisit", 2), (2, 1203, sha(body), "response", None), (3, 5, sha("short"), "response", None), (4, 5, sha("short"), "response", None),
        (5, 0, sha(""), "response", None), (None, 1203, sha(body), "response", None), (6, 1200, sha("é" * 600), "response", None), (6, 1200, sha("é" * 600), "response", None)])
    revisits = warc.read_archives(spark, path).filter("record_type = 'revisit'")
    assert "Filter (" not in revisits._jdf.queryExecution().executedPlan().toString()
    split = spark.read.format("warc").option("splitBytes", "300").load(path)
    assert split.count() == len(rows) == spark.read.format("warc").load(path).count()
    reader = warc.WarcReader(split.schema, {"path": path, "splitBytes": "300"})
    assert len(reader.partitions()) > len(warc.WarcReader(split.schema, {"path": path}).partitions())
    assert warc.round_trip(pages.limit(0), scratch(spark, "warc-none")).count() == 0


def test_archives_are_plain_warc(spark):
    path = scratch(spark, "warc-plain")
    warc.register(spark)
    warc.archive_rows(table(spark, TINY, "pages").limit(5)).coalesce(1).write.format("warc").mode("append").save(path)
    import glob

    text = b"".join(gzip.open(f).read() for f in glob.glob(f"{path}/*.warc.gz"))
    assert text.count(b"WARC/1.1\r\n") == 5 and b"WARC-Type: response\r\n" in text


# ------------------------------------------------------------------ 8 BPE

def test_bpe_equals_tokenizers(spark, odd):
    from tokenizers import Tokenizer

    path = vocabulary("word_bpe_49k.json")
    tokenizer, own = Tokenizer.from_file(path), bpe.word_bpe(path)
    tokenizer.no_truncation()
    tokenizer.no_padding()
    rng = random.Random(1)
    texts = [t or "" for _, t in ODD] + ["ΣΣ XΣ", "İ ﬁ é", "\x1c a\x1db", "\x00a\x00", "a" * 3000, "###$$$ %%%a", "I'M it's 'S ''s don't"]
    texts += ["".join(rng.choice(" \n\t.,'abcdeéÉßẞΣσ1²漢😀́\x1c <|>$") for _ in range(rng.randint(1, 60))) for _ in range(1500)]
    texts += [r.text for r in table(spark, TINY, "documents").collect()]
    for text in texts:
        ids = tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(own.encode(text), "<u4").tolist() == ids, text[:80]
        assert own.decode(own.encode(text)).decode() == tokenizer.decode(ids, skip_special_tokens=False)
    rows = {(r.doc_id, bytes(r.ids)) for r in bpe.encode_documents(odd, path).collect()}
    assert rows == {(i, own.encode(t or "")) for i, t in ODD}
    digests = {(r.doc_id, r.n_tokens, r.ids_sha256) for r in bpe.token_digests(odd, path).collect()}
    assert digests == {(i, len(x) // 4, hashlib.sha256(x).hexdigest()) for i, x in rows}
    assert bpe.token_digests(odd.limit(0), path).count() == 0


# ------------------------------------------------------------------ 9 quality

def test_quality_counts(spark, odd):
    text = "the cat sat on the mat. " * 12 + "\nline\nline\n \n#$% x"
    rows = [(1, text), (2, "a b c d a b c d"), (3, "word " * 60), (4, " ".join(f"the{n} of" for n in range(40)) + " the")]
    got = {r.doc_id: r for r in quality.score_quality(spark.createDataFrame(rows, "doc_id long, text string")).collect()}
    assert (got[1].n_words, got[1].n_symbols, got[1].n_dup_lines, got[1].n_repeat_words) == (76, 3, 1, 72)
    assert got[2].n_repeat_words == 8 and got[2].base_failed and got[3].base_failed and got[3].n_repeat_words == 60
    assert not got[4].base_failed and got[4].kept
    found = quality.score_quality(odd).collect()
    assert len(found) == len(ODD) and not any(r.kept for r in found if not (r.n_words > 50))
    kept = quality.keep_good(odd)
    assert kept.columns == odd.columns and quality.keep_good(odd.limit(0)).count() == 0
    with pytest.raises(ValueError, match="unknown figure"):
        quality.compile_rules((quality.Threshold("nothing", low=1),))


def test_quality_keeps_labelled_good(spark):
    got = queries.op9_quality(spark, SMALL_SF).join(table(spark, SMALL_SF, "labels"), "doc_id").filter("not base_failed").toPandas()
    assert (got.kept == (got.quality == 1)).mean() > 0.99


# ------------------------------------------------------------------ 10 sharding

def test_shards(spark, odd):
    def jump(key, shards):
        key, b, j = key % 2**64, -1, 0
        while j < shards:
            b = j
            key = (key * sharding.JUMP_MULTIPLIER + 1) % 2**64
            j = int((b + 1) * (2**31 / ((key >> 33) + 1)))
        return b

    got = sharding.shard_documents(odd).collect()
    assert len(got) == len(ODD)
    slots = collections.defaultdict(list)
    for r in got:
        assert r.shard == jump(r.doc_id or 0, 24) and r.grown_shard == jump(r.doc_id or 0, 25)
        assert r.grown_shard in (r.shard, 24)
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    of = {(i, (len((t or "").encode()) + 8, zlib.crc32((t or "").encode()))) for i, t in ODD}
    assert {(r.doc_id, (r["size"], r.text_crc32)) for r in got} == of
    assert sharding.shard_documents(odd.limit(0)).count() == 0


# ------------------------------------------------------------------ pipeline

def test_pipeline_stages(spark):
    docs = table(spark, TINY, "documents")
    seen = {}
    for name, stage in corpus_pipeline.STAGES:
        path = scratch(spark, f"stage-{name}")
        stage(spark, docs, TINY).write.parquet(path)
        seen[name] = (docs, spark.read.parquet(path))
        docs = seen[name][1]
    for name in ("toxicity", "quality", "near_duplicates"):
        before, after = seen[name]
        assert before.columns == after.columns and after.exceptAll(before).count() == 0
    before, after = seen["toxicity"]
    scores = {r.doc_id: r.predicted for r in toxicity.score_documents(before, table(spark, TINY, "labels")).collect()}
    assert {r.doc_id for r in after.collect()} == {i for i, p in scores.items() if not p}
    before, after = seen["quality"]
    assert {r.doc_id for r in after.collect()} == {r.doc_id for r in quality.score_quality(before).collect() if r.kept}
    before, after = seen["near_duplicates"]
    groups = brute_components([(r.doc_id, r.text) for r in before.collect()], 5, 80)
    assert {r.doc_id for r in after.collect()} == {g[2] for g in groups}
    before, after = seen["packing"]
    checked_packing([(r.doc_id, r.text) for r in before.collect()], after.collect())
