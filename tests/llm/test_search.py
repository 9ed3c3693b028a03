"""Near-duplicates, URL filter and top-k search."""

import random

import numpy as np
import pyarrow as pa
import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import mtree, url_filter, weighted_minhash as wm
from ledgerloom.llm.common import linked_classes
from tests.llm.helpers import AWKWARD, DOCUMENTS, clashing, document_frequencies, documents, rows


def weighted_jaccard(a, b):
    """Over counts of runs of five words, all of one weight."""

    def bag(text):
        words = text.lower().split()
        runs = [tuple(words[i : i + 5]) for i in range(len(words) - 4)] or [tuple(words)] * bool(words)
        return {run: runs.count(run) for run in runs}

    x, y = bag(a), bag(b)
    least = sum(min(x.get(k, 0), y.get(k, 0)) for k in {*x, *y})
    most = sum(max(x.get(k, 0), y.get(k, 0)) for k in {*x, *y})
    return least / most if most else 1.0


NO_WEIGHTS = wm.Weights(100, np.zeros(0, "u8"), np.zeros(0))


def test_similarity_equals_brute_force():
    rng = random.Random(1)
    texts = [" ".join(rng.choice("a b c dé E f".split()) for _ in range(rng.choice([0, 1, 4, 5, 9, 60]))) for _ in range(300)]
    texts += ["", " \n", "x" * 5000, "a\tb\nc  d e", "A B C D E"]
    others = texts[::-1]
    got = wm.similarities(texts, others, NO_WEIGHTS)
    assert got == pytest.approx([weighted_jaccard(a, b) for a, b in zip(texts, others)])


def test_draws_agree_as_often_as_texts_are_alike():
    rng = random.Random(2)
    words = [f"w{i}" for i in range(400)]
    for kept in (380, 300, 200):
        shares = []
        for _ in range(20):
            rng.shuffle(words)
            texts = [" ".join(words), " ".join(words[:kept] + [f"x{i}" for i in range(400 - kept)])]
            [(count, doc, runs, n)] = wm.shingles(pa.array(texts))
            drawn = wm.draws(doc, runs, NO_WEIGHTS.of(runs, n), count)
            shares.append((drawn[0] == drawn[1]).mean())
        want = weighted_jaccard(*texts)
        assert np.mean(shares) == pytest.approx(want, abs=0.05)


def test_document_frequencies_are_exact(spark):
    rng = random.Random(3)
    passage = "this passage is found in many of the documents at once"
    docs = []
    for i in range(400):
        text = " ".join(f"t{rng.randrange(10**6)}" for _ in range(20))
        docs.append((i, text + " " + passage * (i % 3 == 0), "en", "a", 0))
    weights = document_frequencies(documents(spark, docs).select("doc_id", "text"))
    [(_, _, runs, n)] = wm.shingles(pa.array([passage]))
    inside = set(weights.runs.tolist())
    # runs of the passage alone, without the word before it
    assert set(runs.tolist()) <= inside
    idf = weights.of(runs, n)
    assert idf == pytest.approx([1 + np.log(401 / 135)] * len(runs))
    assert weights.of(np.array([12345], "u8"), np.array([2])) == pytest.approx([2 * weights.most])


def test_every_run_has_its_document_frequency(spark):
    """Runs of 2 to 40 of 400 documents, a tenth and less, weigh by their own counts."""
    rng = random.Random(13)
    docs = []
    for i in range(400):
        shared = [f"p{size}x{k}" for size in (2, 3, 7, 40) if i < size for k in range(9)]
        docs.append((i, " ".join(shared + [f"t{rng.randrange(10**6)}" for _ in range(20)]), "en", "a", 0))
    df = documents(spark, docs + docs[:1] * 3).select("doc_id", "text")
    texts = [r.text for r in df.collect()]
    held = {}
    for text in texts:
        [(_, _, runs, _)] = wm.shingles(pa.array([text]))
        for run in runs.tolist():
            held[run] = held.get(run, 0) + 1
    signed, weights = wm.signatures(df)
    key = F.sha2("text", 256).substr(1, 32)
    by_node = {r.k: r.text for r in df.select("text", F.lower(key).alias("k")).collect()}
    seen = 0
    for r in signed.collect():
        [(_, _, runs, n)] = wm.shingles(pa.array([by_node[bytes(r.node).hex()]]))
        want = [1 + np.log((len(texts) + 1) / (max(held[run], 2) + 1)) for run in runs.tolist()]
        assert weights.of(runs, n, bytes(r.found)) == pytest.approx(n * want)
        seen += 1
    assert seen == len(texts) and set(held.values()) >= {1, 3, 5, 6, 10, 43} - {1, 3}


def test_packed_runs_come_back():
    runs = np.unique(np.random.default_rng(1).integers(0, 1 << 52, 1000).astype("u8"))
    for some in (runs, runs[:1], runs[:0]):
        assert (wm._unpack(wm._pack(some)) == some).all()


def near_copies(rng, text, n, changes):
    words = text.split()
    for _ in range(n):
        copy = list(words)
        for _ in range(changes):
            copy[rng.randrange(len(copy))] = f"new{rng.randrange(10**6)}"
        yield " ".join(copy)


def test_near_duplicates(spark):
    rng = random.Random(4)

    def text():
        return " ".join(f"v{rng.randrange(5000)}" for _ in range(300))

    texts, groups = [], []
    for size in (1, 1, 2, 5, 60):
        base = text()
        texts += [base, *near_copies(rng, base, size - 1, 3)]
        groups += [len(groups) and max(groups) + 1 or 0] * 0 + [size * 1000 + len(texts)] * size
    texts += [texts[0]] * 3  # exact copies
    groups += [groups[0]] * 3
    # a chain: each link is similar, its ends are not
    chain = [text().split()]
    for _ in range(4):
        following = list(chain[-1])
        at = 40 * len(chain)
        following[at : at + 25] = [f"c{rng.randrange(10**6)}" for _ in range(25)]
        chain.append(following)
    texts += [" ".join(words) for words in chain]
    groups += [-1] * len(chain)
    docs = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    got = {r.doc_id: r for r in wm.near_duplicates(clashing(documents(spark, docs))).collect()}
    least = {g: groups.index(g) for g in groups}
    assert {i: r.class_id for i, r in got.items()} == {i: least[g] for i, g in enumerate(groups)}
    assert {i: r.class_size for i, r in got.items()} == {i: groups.count(g) for i, g in enumerate(groups)}
    kept = wm.one_per_class(documents(spark, docs))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(least.values()))


def classes_of(texts, linked):
    least = list(range(len(texts)))

    def root(i):
        while least[i] != i:
            i = least[i]
        return i

    for i, j in linked:
        a, b = sorted((root(i), root(j)))
        least[b] = a
    return [root(i) for i in range(len(texts))]


@pytest.mark.parametrize("fruitful", [0, 10**9])
def test_rest_links_join_what_any_links_join(spark, monkeypatch, fruitful):
    """By further pivots or by blocks only: as comparing all pairs of a bucket."""
    monkeypatch.setattr(wm, "FRUITFUL", fruitful)
    monkeypatch.setattr(wm, "MET", 7)
    rng = random.Random(9)
    base = [" ".join(f"v{rng.randrange(5000)}" for _ in range(120)) for _ in range(3)]
    texts = [t for b in base for k in (1, 2, 3, 5) for t in near_copies(rng, b, 6, k)]
    texts += [" ".join(f"z{i}{k}" for i in range(100)) for k in range(5)]
    df = documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)]).select("doc_id", "text")
    nodes = df.select(F.col("doc_id").alias("id"), wm.text_key(F.col("text")).alias("node"))
    places = [(i, b, 100, -1) for i in range(len(texts)) for b in (7, 8 + i % 2)]
    placed = spark.createDataFrame(places, "id bigint, bucket bigint, n bigint, pivot bigint")
    known = spark.createDataFrame([(i, 0) for i in range(4)], "node bigint, class bigint")
    got = wm._rest_links(placed, known, nodes, df, NO_WEIGHTS).collect()
    alike = {(i, j): weighted_jaccard(texts[i], texts[j]) >= 0.8 for i in range(len(texts)) for j in range(i)}
    assert all(alike[max(r.a, r.b), min(r.a, r.b)] for r in got)
    given = [(0, i) for i in range(4)]
    want = classes_of(texts, given + [pair for pair, near in alike.items() if near])
    assert classes_of(texts, given + [(r.a, r.b) for r in got]) == want
    assert wm._rest_links(placed.where("id < 4"), known, nodes, df, NO_WEIGHTS) is None


def test_classes_and_recall_under_the_weights_of_the_whole_table(spark):
    """All pairs compared by brute force with TF-IDF weights, near the threshold too."""
    rng = random.Random(12)
    common = " ".join(f"p{i}" for i in range(60))
    texts = []
    for g in range(25):
        base = " ".join(f"g{rng.randrange(9000)}" for _ in range(rng.randrange(40, 200)))
        base = f"{common} {base}" if g % 3 == 0 else base
        texts += [base, *near_copies(rng, base, 4, rng.choice([1, 2, 4, 8]))]
    texts += texts[:10] + ["", "a b", "a b"]
    df = documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)]).select("doc_id", "text")
    weights = document_frequencies(df)
    pairs = [(i, j) for i in range(len(texts)) for j in range(i)]
    alike = []
    for at in range(0, len(pairs), 1000):
        sides = zip(*[(texts[i], texts[j]) for i, j in pairs[at : at + 1000]])
        alike += wm.similarities(*map(list, sides), weights).tolist()
    words = [bool(t.split()) for t in texts]
    links = [(i, j) for (i, j), s in zip(pairs, alike) if s >= 0.8 and (texts[i] == texts[j] or words[i] and words[j])]
    got = {r.doc_id: r.class_id for r in wm.near_duplicates(df).collect()}
    found = sum(got[i] == got[j] for i, j in links)
    assert len(links) > 100 and found >= 0.99 * len(links)
    # nothing is in one class that no chain of links joins
    want = classes_of(texts, links)
    assert all(want[i] == want[got[i]] for i in got)


def test_copies_of_a_large_group_are_one_class(spark):
    """A group's own copies do not make its runs common; a passage of other texts stays common."""
    rng = random.Random(21)

    def text(size):
        return " ".join(f"l{rng.randrange(9000)}" for _ in range(size))

    base, passage = text(200), text(45)
    copies = [t for changes in (2, 3) for t in near_copies(rng, base, 80, changes)]
    texts = [base, *copies, *copies[:20]]
    # the passage is most of some texts, and little of all others that have it
    texts += [f"{text(5)} {passage}" for _ in range(6)] + [f"{text(150)} {passage}" for _ in range(100)]
    texts += [text(30) for _ in range(400)]
    df = documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)]).select("doc_id", "text")
    got = {r.doc_id: r.class_id for r in wm.near_duplicates(df).collect()}
    assert min(weighted_jaccard(base, t) for t in copies) >= 0.84
    assert min(weighted_jaccard(texts[181], t) for t in texts[182:187]) >= 0.79
    assert [got[i] for i in range(181)] == [0] * 181
    assert [got[i] for i in range(181, len(texts))] == list(range(181, len(texts)))


def test_large_groups_of_copies_count_as_one_document(spark):
    rng = random.Random(22)
    group, passage, few = (" ".join(f"{c}{k}" for k in range(40)) for c in "gpf")
    texts = [f"{group} x{i}" for i in range(60)] + [f"{few} y{i}" for i in range(wm.FEW)]
    texts += [f"{passage} {' '.join(f'z{rng.randrange(10**6)}' for _ in range(100))}" for _ in range(50)]
    df = documents(spark, [(i, t, "en", "a", 0) for i, t in enumerate(texts)]).select("doc_id", "text")
    for grouped, many in ((False, 60), (True, 1)):
        signed, weights = wm.signatures(df, grouped)
        for r in signed.where("doc_id IN (0, 60, 100)").collect():
            [(_, _, runs, n)] = wm.shingles(pa.array([texts[r.doc_id]]))
            [(_, _, inner, _)] = wm.shingles(pa.array([{0: group, 60: few, 100: passage}[r.doc_id]]))
            idf = weights.of(runs, n, bytes(r.found))[np.isin(runs, inner)]
            held = {0: many, 60: wm.FEW, 100: 50}[r.doc_id]
            assert idf == pytest.approx([1 + np.log((len(texts) + 1) / (max(held, 2) + 1))] * 36)


def test_no_document_is_lost_where_ids_repeat(spark):
    rng = random.Random(13)
    one, two, three = (" ".join(f"r{rng.randrange(9000)}" for _ in range(60)) for _ in range(3))
    docs = [(1, one, "en", "a", 1), (1, two, "en", "b", 2), (1, one, "en", "a", 1), (2, three, "de", "c", 3), (None, three, "de", None, 3), (None, None, None, None, None), (3, two, "es", "d", 4)]
    kept = wm.one_per_class(clashing(documents(spark, docs)))
    assert rows(kept, "doc_id", "text", "source") == sorted([(1, one, "a"), (1, two, "b"), (2, three, "c"), (None, None, None)], key=str)


def test_star_of_copies_is_one_class(spark):
    """Copies that are like their original but not like each other are linked through it."""
    rng = random.Random(11)
    base = " ".join(f"s{rng.randrange(9000)}" for _ in range(150))
    copies = list(near_copies(rng, base, 60, 2))
    far = list(near_copies(rng, base, 10, 12))
    texts = [*copies[:30], base, *copies[30:], *far]
    # so many others that no run of the copies is frequent
    texts += [" ".join(f"o{rng.randrange(10**6)}" for _ in range(8)) for _ in range(1500)]
    docs = [(i, t, "en", "a", 0) for i, t in enumerate(texts)]
    got = {r.doc_id: r.class_id for r in wm.near_duplicates(documents(spark, docs)).collect()}
    for i, text in enumerate(texts[:71]):
        linked = weighted_jaccard(text, base) >= 0.8
        assert (got[i] == 0) or not linked


def test_near_duplicates_of_awkward_rows(spark):
    got = wm.near_duplicates(clashing(documents(spark))).collect()
    assert len(got) == len(AWKWARD)
    classes = {r.doc_id: (r.class_id, r.class_size) for r in got}
    assert classes[1] == classes[10] == (1, 3)
    assert classes[2] == classes[3] == (2, 2) and classes[8] == (8, 1)
    assert classes[None] == (None, 1)
    assert wm.near_duplicates(spark.createDataFrame([], DOCUMENTS)).count() == 0
    kept = wm.one_per_class(documents(spark)).collect()
    assert sorted([r.doc_id for r in kept], key=str) == [1, 2, 4, 5, 6, 7, 8, 9, None]


def test_linked_classes(spark):
    rng = random.Random(5)
    edges = [(rng.randrange(400), rng.randrange(400)) for _ in range(260)] + [(i, i + 1) for i in range(500, 600)]
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    least = {n: n for e in edges for n in e}
    for _ in range(len(edges)):
        for a, b in edges:
            least[a] = least[b] = min(least[a], least[b])
    linked = {n for a, b in edges if a != b for n in (a, b)}
    got = {r["node"]: r["class"] for r in linked_classes(df).collect()}
    assert {n: got.get(n, n) for n in linked} == {n: least[n] for n in linked}


URLS = [
    ("https://www.example.com/en/1", "www.example.com", "/en/1", "www.example.com/en/", "allow"),
    ("https://EXAMPLE.com/en/1?q=1#x", "example.com", "/en/1", "example.com/en/", "block"),
    ("https://a.b.example.com/fr/", "a.b.example.com", "/fr/", "com/", "allow"),
    ("http://notexample.com/en/", "notexample.com", "/en/", "com/", "allow"),
    ("http://x.net/es/y", "x.net", "/es/y", "net/es/", "block"),
    ("http://x.net/es", "x.net", "/es", None, "allow"),
    ("http://com", "com", "", None, "allow"),
    ("http://com/", "com", "/", "com/", "allow"),
    ("no scheme.com/", "", "", None, "allow"),
    ("://", "", "", None, "allow"),
    ("", "", "", None, "allow"),
    (None, "", "", None, "allow"),
    ("http://ÄB.com/Ä?://z", "Äb.com", "/Ä", "com/", "allow"),
    ("http://" + "a." * 3000 + "net/fr/" + "x" * 5000, "a." * 3000 + "net", "/fr/" + "x" * 5000, "net/fr/", "block"),
]


def test_url_rules(spark):
    df = spark.createDataFrame([(i, u[0]) for i, u in enumerate(URLS)], "page_id bigint, url string")
    for name in ("key", "block", "rule", "host", "html"):
        df = df.withColumn(name, F.lit("mine"))
    got = {r.page_id: (r.host, r.path, r.rule, r.verdict) for r in url_filter.judge(df).collect()}
    assert got == {i: u[1:] for i, u in enumerate(URLS)}
    assert url_filter.judge(df.limit(0)).count() == 0


def test_listed_urls_and_false_positives(spark):
    pages = [(i, f"http://h{i % 50}.org/p{i}?utm_source=x") for i in range(2000)]
    df = spark.createDataFrame(pages, "page_id bigint, url string")
    listed = spark.createDataFrame([(f"https://h{i % 50}.org/p{i}/",) for i in range(0, 2000, 7)] + [(None,)], "url string")
    want = [(i, "block" if i % 7 == 0 else "allow") for i in range(2000)]
    # a filter of one block lets nearly everything through; the join still decides
    for blocks in (1, 1 << 17):
        got = url_filter.judge(df, listed, max_blocks=blocks)
        assert rows(got, "page_id", "verdict") == sorted(want, key=str)


def test_bloom_passes_all_members_and_few_others(spark):
    keys = spark.range(3000).select(F.col("id").cast("string").alias("key"))
    bloom = url_filter.blocked_bloom(keys.where("id < 1000"), 32)
    assert bloom.count() <= 32
    passed = {int(r.key) for r in url_filter.may_contain(keys, bloom, 32).collect()}
    assert set(range(1000)) <= passed and len(passed) < 1200


def test_canonical_urls(spark):
    urls = ["http://A.b/c/?b=2&a=1&utm_x=3#f", "https://a.b/c?a=1&b=2", "http://a.b", "x", None]
    df = spark.createDataFrame([(u,) for u in urls], "url string")
    got = [r.c for r in df.select(url_filter.canonical(F.col("url")).alias("c")).collect()]
    assert got == ["a.b/c?a=1&b=2", "a.b/c?a=1&b=2", "a.b", None, None]


VECTORS = "vec_id bigint, embedding array<float>"


def brute(vectors, is_query, k=10):
    whole = {(i, tuple(int(np.floor(1024.0 * float(np.float32(x)))) for x in v)) for i, v in vectors}
    found = []
    for q, a in sorted(whole):
        if not is_query(q):
            continue
        best: dict = {}
        for c, b in whole:
            if c != q and len(a) == len(b):
                best[c] = max(best.get(c, -(10**18)), sum(x * y for x, y in zip(a, b)))
        ranked = sorted(best.items(), key=lambda x: (-x[1], x[0]))[:k]
        found += [(q, rank + 1, c, s) for rank, (c, s) in enumerate(ranked)]
    return found


@pytest.mark.parametrize("pivots,part_rows,block", [(4, 50, 2), (64, 8192, 1024)])
def test_top_k_equals_brute_force(spark, monkeypatch, pivots, part_rows, block):
    monkeypatch.setattr(mtree, "PAGE", 8)
    rng = np.random.default_rng(7)
    centers = rng.normal(size=(5, 6))
    vectors = [(i, (centers[i % 5] + 0.3 * rng.normal(size=6)).tolist()) for i in range(400)]
    vectors += [(1000 + i, [0.25] * 6) for i in range(120)]  # ties
    vectors += [(2000 + i, [0.0] * 6) for i in range(30)]
    vectors += [(3000, [1.0, 2.0]), (3010, [2.0, -1.0]), (3020, [])]
    df = spark.createDataFrame(vectors, VECTORS)
    bad = [(4000, None), (4010, [1.0] * 5 + [None]), (4020, [float("nan")] * 6), (4030, [float("inf")] * 6), (None, [1.0] * 6)]
    df = df.unionByName(spark.createDataFrame(bad + vectors[:3], VECTORS))
    for name in ("v", "dim", "node", "score"):
        df = df.withColumn(name, F.lit("mine"))
    got = mtree.top_k(df, F.col("vec_id") % 10 == 0, pivots=pivots, part_rows=part_rows, query_block=block)
    assert rows(got, "query_id", "rank", "vec_id", "score") == sorted(brute(vectors, lambda i: i % 10 == 0), key=str)


def test_top_k_of_few_or_no_rows(spark):
    empty = spark.createDataFrame([], VECTORS)
    assert mtree.top_k(empty, F.lit(True)).count() == 0
    one = spark.createDataFrame([(0, [1.0, 0.5])], VECTORS)
    assert mtree.top_k(one, F.lit(True)).count() == 0
    three = spark.createDataFrame([(0, [1.0]), (1, [0.5]), (2, [-1.0])], VECTORS)
    got = mtree.top_k(three, F.col("vec_id") == 0)
    assert rows(got, "rank", "vec_id", "score") == [(1, 1, 524288), (2, 2, -1048576)]


def test_tree_pages(spark):
    rng = np.random.default_rng(8)
    v = rng.integers(-500, 500, (700, 5))
    v[:400] = v[0]
    top = float((v * v).sum(1).max()) + 1
    pages = mtree.build_tree(np.arange(700), v, top)
    leaves = [np.frombuffer(p[6], "i8") for p in pages if p[2]]
    assert sorted(np.concatenate(leaves).tolist()) == list(range(700))
    assert max(map(len, leaves)) <= mtree.PAGE
