"""Vector classes, spelling variants and phrases against brute force, with awkward rows."""

import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest

from ledgerloom.llm import flat_graph, phrases, spelling
from tests.llm.helpers import AWKWARD, clashing, documents, rows

VECTORS = "vec_id bigint, embedding array<double>, label int"


# --- vectors -------------------------------------------------------------------------------------


def vector_classes(data):
    """n_links and component_id of every row by comparing all pairs."""
    units, labels = [], []
    for _, v, label in data:
        good = v is not None and label is not None and len(v) and None not in v and np.isfinite(v).all() and any(v)
        units.append(np.array(v, float) / np.abs(v).max() if good else None)
        labels.append(label)
    near = defaultdict(set)
    for i, a in enumerate(units):
        for j, b in enumerate(units):
            if i != j and a is not None and b is not None and labels[i] == labels[j] and len(a) == len(b):
                if a @ b / np.sqrt((a @ a) * (b @ b)) >= 0.93:
                    near[i].add(j)
    found = []
    for i, (vec_id, _, _) in enumerate(data):
        seen, todo = {i}, [i]
        while todo:
            new = near[todo.pop()] - seen
            seen |= new
            todo += new
        low = min((data[j][0] for j in seen if data[j][0] is not None), default=None)
        found.append((vec_id, len(near[i]), low, vec_id == low))
    return sorted(found, key=str)


def vectors(seed, number=600, dims=16):
    rng = np.random.default_rng(seed)
    centers = rng.normal(size=(number // 12, dims))
    data = []
    for i in range(number):
        center = centers[int(rng.integers(len(centers)) * rng.random())]
        data.append((i, (center + rng.normal(size=dims) * rng.choice([0, 0.05, 0.15, 0.3])).tolist(), int(i % 5 == 0)))
    return data


ODD = [
    (9001, None, 1), (9002, [], 1), (9003, [0.0] * 16, 1), (9004, [float("nan")] * 16, 1), (9005, [None] * 16, 1),
    (9006, [float("inf")] + [1.0] * 15, 1), (9007, [1.0] * 16, None), (9008, [1.0] * 16, None),
    (9009, [1e300] * 16, 7), (9010, [1e-300] * 16, 7), (9011, [1.0] * 15, 7), (9012, [-1.0] * 16, 7),
    (9013, [2.0] * 16, 7), (9013, [2.0] * 16, 7), (None, [2.0] * 16, 7), (None, None, None),
    (9014, [-0.0] + [1.0] * 15, 8), (9015, [0.0] + [1.0] * 15, 8),
]


def test_vector_classes_equal_brute_force(spark):
    data = vectors(1) + ODD
    got = flat_graph.near_duplicates(clashing(spark.createDataFrame(data, VECTORS)))
    assert rows(got) == vector_classes(data)


@pytest.mark.parametrize("limit", [{"HOMES": 24, "GUESTS": 20}, {"HOMES": 64, "ROUNDS": 0, "CANDIDATES": 4, "DEGREE": 2, "BEAM": 2}])
def test_vector_classes_of_split_cells(spark, monkeypatch, limit):
    """Cells that are split in rounds, and by hashes; graphs of few edges, where the audit widens the margin."""
    for name, value in {**limit, "RECALL": 1.0, "AUDITED": 1000}.items():
        monkeypatch.setattr(flat_graph, name, value)
    data = vectors(2, 300)
    assert rows(flat_graph.near_duplicates(spark.createDataFrame(data, VECTORS))) == vector_classes(data)


def test_dense_groups_are_counted_by_their_radius(spark, monkeypatch):
    """A third of all vectors nearly alike: covered cells leave nothing to search."""
    monkeypatch.setattr(flat_graph, "HOMES", 32)
    rng = np.random.default_rng(3)
    center = rng.normal(size=16)
    data = [(i, (center + rng.normal(size=16) * 0.02).tolist(), 1) for i in range(200)]
    data += [(200 + i, rng.normal(size=16).tolist(), 1) for i in range(100)] + [(300, center.tolist(), 1)] * 9
    df = spark.createDataFrame(data, VECTORS)
    assert rows(flat_graph.near_duplicates(df)) == vector_classes(data)
    units = df.mapInArrow(flat_graph._units, "vec_id bigint, cell string, key binary, unit binary")
    nodes = units.where("vec_id < 200").selectExpr("vec_id AS node", "CAST(1 AS BIGINT) AS copies", "unit", "cell")
    members, covered = flat_graph._cells(nodes, 0.1)
    assert members.where("asks").isEmpty() and covered.groupBy().sum("linked").first()[0] == 200 * 199


def test_recall_is_measured_against_all_nodes(spark):
    data = vectors(4, 100)
    df = spark.createDataFrame([(i, v, 1) for i, v, _ in data], VECTORS)
    units = df.mapInArrow(flat_graph._units, "vec_id bigint, cell string, key binary, unit binary")
    nodes = units.selectExpr("vec_id AS node", "CAST(1 AS BIGINT) AS copies", "unit", "cell").cache()
    none = spark.createDataFrame([], "node bigint, linked bigint")
    assert flat_graph.recall(nodes, none) == 0.0
    assert flat_graph.recall(nodes, flat_graph.links(nodes).groupBy("node").agg({"linked": "sum"}).toDF("node", "linked")) == 1.0


def test_empty_vectors(spark):
    assert flat_graph.near_duplicates(spark.createDataFrame([], VECTORS)).count() == 0
    only = spark.createDataFrame([(1, None, 1)], VECTORS)
    assert rows(flat_graph.near_duplicates(only)) == [(1, 0, 1, True)]


# --- spelling ------------------------------------------------------------------------------------


def spelled(data):
    counts = Counter()
    for doc_id, text, *_ in data:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = "".join(c.lower() if c.isascii() else c for c in run)
            h = crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            counts[run if h % 97 else run[: h % len(run)] + run[h % len(run) + 1 :]] += 1
    counts = {w: n for w, n in counts.items() if len(w) >= 5 and n >= 3}

    def near(a, b):
        if len(a) == len(b):
            return sum(x != y for x, y in zip(a, b)) == 1
        a, b = sorted((a, b), key=len)
        return len(b) == len(a) + 1 and any(a == b[:i] + b[i + 1 :] for i in range(len(b)))

    found, forms = {}, {}
    for w, n in counts.items():
        others = [v for v in counts if near(w, v)]
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        if best and counts[best] >= 2 * n:
            forms[w] = best
        found[w] = len(others)

    def root(w):
        return root(forms[w]) if w in forms else w

    return sorted(
        ((w, forms.get(w), root(w), n, found[w], counts.get(forms.get(w))) for w, n in counts.items()), key=str
    )


COLUMNS = "word", "form", "root", "n", "n_near", "form_n"


def test_variants_equal_brute_force(spark):
    rng = np.random.default_rng(5)
    words = ["".join(rng.choice(list("abAé"), rng.integers(4, 8))) for _ in range(300)]
    texts = [" ".join(words[int(len(words) * rng.random() ** 2)] for _ in range(80)) for _ in range(60)]
    data = [(i, t, "en", "a", len(t)) for i, t in enumerate(texts)] + AWKWARD * 3
    got = spelling.variants(clashing(documents(spark, data)))
    assert rows(got, *COLUMNS) == spelled(data)
    assert got.where("form IS NOT NULL AND root <> form").count()  # chains of forms


@pytest.mark.parametrize("alphabet", [1, 3, 64])
def test_reduced_neighbours_hold_all_edits(alphabet):
    """Whatever the alphabet, words one edit apart share a key or meet as key and neighbour."""
    words = ["abcde", "abcdf", "abcdef", "abxde", "aabcde", "abcd", "aaaaa", "aaaaaa", "é" * 5, "zz", "qqqqq"]
    letters = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").astype("u8")
    symbols = spelling._mix(letters) % np.uint64(alphabet) + np.uint64(1)
    reduced = spelling.Reduced(symbols, np.array([len(w) for w in words]))
    met = {(int(reduced.keys[w]), int(k)) for ws, ks in reduced.neighbours(alphabet) for w, k in zip(ws, ks)}
    for i, a in enumerate(words):
        for j, b in enumerate(words):
            ka, kb = int(reduced.keys[i]), int(reduced.keys[j])
            near = abs(len(a) - len(b)) <= 1 and a != b and (
                sum(x != y for x, y in zip(a, b)) == 1 if len(a) == len(b)
                else any(min(a, b, key=len) == max(a, b, key=len)[:k] + max(a, b, key=len)[k + 1 :] for k in range(7))
            )
            assert not near or ka == kb or (ka, kb) in met or (kb, ka) in met


def test_no_words(spark):
    assert spelling.variants(documents(spark, [])).count() == 0
    assert spelling.variants(documents(spark, [(1, "12 ab", "en", "a", 5), (2, None, None, None, None)])).count() == 0


# --- phrases -------------------------------------------------------------------------------------


def phrase_rows(data, top=2000):
    sizes, f = Counter(), Counter()
    for _, text, lang, *_ in data:
        lang = "und" if lang is None else lang
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for piece in re.split("[.,;:!?\x0a-\x0d]", lower):
            words = re.findall("[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            for k in (1, 2, 3):
                for i in range(len(words) - k + 1):
                    f[lang, *words[i : i + k]] += 1
    found = defaultdict(list)
    for (lang, *p), a in f.items():
        if len(p) < 2 or a < 10:
            continue
        if len(p) == 2 and any(
            100 * n >= 50 * a for (x, *q), n in f.items() if x == lang and len(q) == 3 and n >= 10 and p in (q[:2], q[1:])
        ):
            continue
        cuts = [(10**6 * a * a // (f[lang, *p[:k]] * f[lang, *p[k:]]), k) for k in range(1, len(p))]
        score, k = min(cuts)
        found[lang].append((-score, -a, " ".join(p).encode(), f[lang, *p[:k]], f[lang, *p[k:]]))
    return sorted(
        (
            (lang, rank, p.decode(), -a, left, right, sizes[lang], -score)
            for lang, each in found.items()
            for rank, (score, a, p, left, right) in enumerate(sorted(each)[:top], 1)
        ),
        key=str,
    )


def texts_of(seed, words="A b x c d é ff, g; h", number=60):
    rng = np.random.default_rng(seed)
    words = words.split(" ")
    langs = ["en", "de", None, "en", "und"]
    rows_ = []
    for i in range(number):
        t = "".join(words[int(len(words) * rng.random() ** 1.5)] + rng.choice([" ", "  ", "\t", "\n", " . "], p=[0.7, 0.1, 0.1, 0.05, 0.05]) for _ in range(120))
        rows_.append((i, t, langs[i % 5], "a", len(t)))
    return rows_


def test_phrases_equal_brute_force(spark):
    data = texts_of(6) + AWKWARD
    got = phrases.collocations(clashing(documents(spark, data)))
    assert rows(got) == phrase_rows(data) and got.count() > 50


def test_phrases_of_many_blocks_and_full_filters(spark, monkeypatch):
    for name, value in {"BLOCK": 500, "ENTRIES": 64, "TOP": 7}.items():
        monkeypatch.setattr(phrases, name, value)
    data = texts_of(7)
    got = phrases.collocations(documents(spark, data).repartition(3))
    assert rows(got) == phrase_rows(data, 7)


@pytest.mark.parametrize("bits", [1, 2, 5, 20, 21, 22, 31, 32])
def test_permutation_is_lossless(bits):
    rng = np.random.default_rng(bits)
    words = [rng.integers(0, 1 << bits, 500, dtype="u8") for _ in range(3)]
    half = phrases.half_bits(bits)
    left, right = phrases.permute(*phrases.pack(*words, bits), half)
    assert max(int(left.max()), int(right.max())) < 1 << half
    back = phrases.unpack(*phrases.restore(left, right, half), bits)
    assert all((a == b).all() for a, b in zip(back, words))
    found = phrases.Filter(half)
    for part in range(0, 500, 100):
        one = phrases.merged(left[part : part + 100], right[part : part + 100], None, half)
        found.add(*one)
        found.add(*one)
    got = phrases.unpack(*phrases.restore(*found.fold()[:2], half), bits)
    assert Counter({w: int(n) for *w, n in zip(*got, found.fold()[2]) for w in [tuple(map(int, w))]}) == Counter(
        {w: 2 * n for w, n in Counter(zip(*(map(int, w) for w in words))).items()}
    )


def test_planes_of_numbers():
    for numbers in ([], [0], [0, 255, 256, 2**64 - 1], [3] * 9):
        numbers = np.array(numbers, "u8")
        assert (phrases._unplaned(phrases._planes(numbers), len(numbers)) == numbers).all()


def test_no_phrases(spark):
    assert phrases.collocations(documents(spark, [])).count() == 0
    assert phrases.collocations(documents(spark, [(1, None, None, None, None), (2, " ., ", "en", "a", 4)])).count() == 0
