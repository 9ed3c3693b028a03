"""Personal data, fingerprints, toxicity and conversations."""

import hashlib
import random
import re

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import pii, quotes, syncmers, toxicity
from tests.llm.helpers import AWKWARD, DOCUMENTS, clashing, documents, rows


def luhn(digits):
    total = 0
    for i, d in enumerate(map(int, reversed(digits))):
        total += d if i % 2 == 0 else 2 * d - 9 * (2 * d > 9)
    return total % 10 == 0


def base_spans(text):
    """The four kinds by the plain patterns."""
    found = []
    for kind, pattern in zip(pii.BASE, (pii.EMAIL, pii.IP, pii.CARD, pii.PHONE)):
        for m in re.finditer(pattern, text):
            digits = re.sub("[^0-9]", "", m[0])
            fine = {
                "email": True,
                "ip": kind != "ip" or all(int(p) <= 255 for p in m[0].split(".")),
                "card": 16 <= len(digits) <= 19 and luhn(digits),
                "phone": 8 <= len(digits) <= 15,
            }
            if fine[kind]:
                found.append((kind, m.start(), m.end()))
    return found


def spans_of(spark, texts):
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id bigint, text string")
    return {r.doc_id: r.spans for r in pii.find(df).collect()}


def test_personal_data_equals_plain_patterns(spark):
    rng = random.Random(1)
    parts = (
        "a@b.c d@e..f a@b.c_d@e.f x.y+z@q-r.st.u @ a@b a@.b a@b. a@b-.c 1.2.3.4 1.2.3.4.5 256.1.1.1 "
        "001.002.3.4 1.2..3.4.5.6 4111111111111111 4111-1111-1111-1111 4111--1111111111111111 5500 "
        "0000000000000000 +1-202-555-0101 +49(30)1234567 +1 +5 + +12345678901234567890 ü é 😀 é@ü.x . .. - 7"
    ).split()
    texts = ["".join(rng.choice(parts) + rng.choice(["", " ", "  ", "-", ".", "\n", "x"]) for _ in range(rng.randint(1, 14))) for _ in range(1500)]
    got = spans_of(spark, texts)
    for i, text in enumerate(texts):
        base = [(s.kind, s.start, s.end) for s in got[i] if s.kind in pii.BASE]
        assert base == base_spans(text), repr(text)
        assert all(text[s.start : s.end] == s.value for s in got[i])


def test_runs_of_one_character_take_linear_time(spark):
    texts = ["7" * 200_000, "a" * 200_000, "a@" + "b." * 50_000, "1 " * 100_000, "+1" + " " * 100_000]
    got = spans_of(spark, texts)
    assert [len(got[i]) for i in range(5)] == [0, 0, 1, 0, 0]
    assert got[2][0].end == 100_001


def test_added_kinds_need_checksum_or_context(spark):
    texts = [
        "pay to DE89 3704 0044 0532 0130 00 now",
        "pay to DE89 3704 0044 0532 0130 01 now",
        "social security 123-45-6789",
        "the part 123-45-6789",
        "write to me@x.org",
        "see me@x.org",
    ]
    got = spans_of(spark, texts)
    assert [[s.kind for s in got[i]] for i in range(4)] == [["iban"], [], ["ssn"], []]
    assert got[4][0].score > got[5][0].score


def test_mask(spark):
    text = "mail a@b.co or +1 202 555 0101, ip 1.2.3.4."
    df = spark.createDataFrame([(text,), (None,), ("",), ("clean",)], "text string")
    masked = pii.find(df).select(pii.mask(F.col("text"), F.col("spans")).alias("m"))
    assert [r.m for r in masked.collect()] == ["mail <EMAIL> or <PHONE>, ip <IP>.", None, "", "clean"]


def test_personal_data_of_awkward_rows(spark):
    got = pii.find(clashing(documents(spark)))
    assert got.count() == len(AWKWARD)
    assert got.where("spans IS NULL").count() == 0
    assert pii.find(spark.createDataFrame([], DOCUMENTS)).count() == 0


def syncmers_of(words):
    """Positions of closed syncmers, by the plain rule, over hashes of runs."""
    k, s = syncmers.K, syncmers.S
    found = []
    for i in range(len(words) - k + 1):
        runs = words[i : i + k - s + 1]
        if min(runs) in (runs[0], runs[-1]):
            found.append(i)
    return found


def test_anchors_are_closed_syncmers(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice("abcdefgh") * rng.randint(1, 3) for _ in range(n)) for n in (5, 6, 30, 200)]
    df = spark.createDataFrame(list(enumerate(texts)), "i int, text string")
    pairs = F.transform(F.split("text", " "), lambda w: F.xxhash64(w))
    runs = F.zip_with(pairs, F.slice(pairs, 2, F.size(pairs)), lambda a, b: F.xxhash64(a, b))
    got = df.select("i", syncmers.anchors(F.col("text")).alias("a"), runs.alias("runs")).collect()
    for r in got:
        count = len(texts[r.i].split())
        # hashes of runs in place of words: the rule compares these
        inner = r.runs[: count - 1]
        want = [
            i
            for i in range(count - syncmers.K + 1)
            if min(inner[i : i + 4]) in (inner[i], inner[i + 3])
        ]
        assert [a.position for a in r.a] == want


def test_anchors_do_not_depend_on_context(spark):
    passage = " ".join(f"w{i % 37}x{i}" for i in range(60))
    texts = [passage, "some words before " + passage, passage + " and words after it"]
    df = spark.createDataFrame([(t,) for t in texts], "text string")
    hashes = [{a.hash for a in r.a} for r in df.select(syncmers.anchors(F.col("text")).alias("a")).collect()]
    assert hashes[0] and hashes[0] <= hashes[1] and hashes[0] <= hashes[2]


def test_fingerprints(spark):
    got = syncmers.fingerprints(clashing(documents(spark))).collect()
    ordered = sorted(AWKWARD, key=lambda r: (r[0] is None, -(r[0] or 0), r[1] or ""))
    texts = [r[1] or "" for r in ordered]
    want = []
    for i, text in enumerate(texts):
        third = len(text) // 3
        edited = text[: len(text) - third] + texts[(i + 1) % len(texts)][:third]
        want.append((ordered[i][0], len(text), hashlib.sha256(edited.encode()).hexdigest()))
    assert sorted([(r.doc_id, r.n_chars, r.edited_sha256) for r in got], key=str) == sorted(want, key=str)
    prints = {r.doc_id: r.fingerprint for r in got}
    assert prints[1] == prints[10] and prints[2] == prints[3] == ""
    assert all(0 <= r.near_edited <= 1 and 0 <= r.near_next <= 1 for r in got)
    assert syncmers.fingerprints(spark.createDataFrame([], DOCUMENTS)).count() == 0
    alone = syncmers.fingerprints(documents(spark, AWKWARD[:1])).first()
    assert alone.near_next == 1.0


def test_next_crosses_slices(spark):
    docs = [(i * 7, f"text {i}", "en", "a", 0) for i in range(500)]
    got = syncmers.with_next(documents(spark, docs).select("doc_id", "text"), ["text"]).collect()
    texts = {r.doc_id: r.next_text for r in got}
    assert texts == {i * 7: f"text {(i - 1) % 500}" for i in range(500)}


def edits(a, b):
    before = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        now = [i]
        for j, y in enumerate(b, 1):
            now.append(min(before[j] + 1, now[-1] + 1, before[j - 1] + (x != y)))
        before = now
    return before[-1]


def test_lexicon_equals_edit_distance():
    terms = ["idiot", "moron", "worthless", "scum", "pathetic", "lowei*", "idiom"]
    lexicon = toxicity.Lexicon(terms)
    rng = random.Random(4)
    words = list(terms)
    for _ in range(4000):
        word = list(rng.choice(terms).rstrip("*"))
        for _ in range(rng.randint(0, 3)):
            i = rng.randrange(len(word) + 1)
            kind = rng.randrange(3)
            if kind == 0:
                word.insert(i, rng.choice("abeiotsxé"))
            elif word and i < len(word):
                word[i : i + 1] = [] if kind == 1 else [rng.choice("abeiotsxé")]
        words.append("".join(word) or "x")
    for word in words:
        best = []
        for t, term in enumerate(terms):
            if term.endswith("*"):
                if word.startswith(term[:-1]) and len(word) > len(term) - 1:
                    best.append((0, t))
            elif edits(word, term) <= toxicity.edits_allowed(term):
                best.append((edits(word, term), t))
        assert lexicon.match(word) == min(best, default=None), word


def test_context_tells_quotation_from_abuse():
    lexicon = toxicity.Lexicon(["idiot"])
    plain = toxicity.features("you idiot go away", lexicon)
    quoted = toxicity.features('she wrote "what an idiot he is" in the paper', lexicon)
    misspelt = toxicity.features("you idiott go away", lexicon)
    assert plain[1] and plain[5] and not plain[4]
    assert quoted[4] and not quoted[1]
    assert misspelt[3] and not misspelt[1]
    model = toxicity.Model(["idiot"])
    scores = [model.score(x) for x in (plain, misspelt, quoted, toxicity.features("", lexicon))]
    assert scores == sorted(scores, reverse=True)


def test_toxicity_learns_and_takes_awkward_rows(spark):
    rng = random.Random(6)
    vocabulary = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(600):
        words = [rng.choice(vocabulary) for _ in range(30)]
        toxic = i % 5 == 0
        if toxic:
            words[rng.randrange(30)] = rng.choice(["nastyterm", "grobian", "vileword"])
        docs.append((i, " ".join(words), "en", "a", 0))
        labels.append((i, 1, int(toxic)))
    labels += [(None, 1, 1), (5, 1, None), (10_000, 0, 1)]
    marked = spark.createDataFrame(labels, "doc_id bigint, quality int, toxic int")
    model = toxicity.learn(clashing(documents(spark, docs)), clashing(marked))
    assert {"nastyterm", "grobian", "vileword"} <= set(model.terms)
    got = {r.doc_id: r for r in toxicity.score(documents(spark, docs), model).collect()}
    held = [r for r in got.values() if r.held_out]
    assert 60 < len(held) < 180
    assert all(r.predicted == (r.doc_id % 5 == 0) for r in held)
    misspelt = documents(spark, [(1, "a nastytirm here", "en", "a", 0)])
    assert toxicity.score(misspelt, model).first().score > got[1].score
    awkward = toxicity.score(clashing(documents(spark)), model).collect()
    assert len(awkward) == len(AWKWARD) and all(0 <= r.score <= 1 for r in awkward)
    kept = toxicity.without_toxic(documents(spark, docs + AWKWARD), model)
    assert kept.columns == documents(spark).columns and kept.count() == 480 + len(AWKWARD)
    none = toxicity.learn(documents(spark, []), marked.limit(0))
    assert none.terms == [] and toxicity.score(documents(spark, []), none).count() == 0


MESSAGES = "conv_id bigint, turn bigint, role string, text string"


def test_parse_nested_quotes():
    text = "On Monday Ann wrote:\n> > deep one\n> > deep two\n> above\n\nmy answer\n>again\nend"
    own, passages = quotes.parse(text)
    assert own == "my answer\nend"
    assert passages == [(2, "deep one\ndeep two"), (1, "above"), (1, "again")]
    assert quotes.parse("") == ("", [])


def test_conversations_link_quotes(spark):
    sent = [
        (1, 0, "a", "first question\nwith two lines"),
        (1, 1, "b", "an answer"),
        (1, 2, "c", "> First   question\n> with two lines\n\nanother answer"),
        (1, 3, "a", "On Tuesday c wrote:\n>> first question\n>> with two lines\n> another answer\nthanks"),
        (2, 0, "d", "> another answer\nelsewhere"),
        (2, 1, "d", None),
        (2, 2, "d", "> never said by anyone\nhm"),
        (None, 0, "e", "> an answer\nlost"),
        (3, None, "e", "no turn"),
        (4, 5, "f", "alone"),
        (4, 5, "f", "alone"),
    ]
    df = spark.createDataFrame(sent, MESSAGES)
    for name in ("hash", "source", "level", "depth", "quoted"):
        df = df.withColumn(name, F.lit("mine"))
    got = quotes.conversations(df)
    told = {(r.conv_id, r.turn): r for r in got.collect()}
    assert got.count() == len(sent)
    assert told[1, 2].text == "another answer" and told[1, 3].text == "thanks"
    parents = {k: (r.parent_turn, r.root_turn, r.depth) for k, r in told.items()}
    assert parents == {
        (1, 0): (None, 0, 0), (1, 1): (0, 0, 1), (1, 2): (0, 0, 1), (1, 3): (2, 0, 2),
        (2, 0): (None, 0, 0), (2, 1): (0, 0, 1), (2, 2): (1, 0, 2),
        (None, 0): (None, None, None), (3, None): (None, None, None), (4, 5): (None, 5, 0),
    }
    assert told[1, 3].n_quotes == 2 and told[1, 3].n_linked == 2
    assert told[2, 0].n_linked == 1 and told[2, 2].n_linked == 0
    assert quotes.conversations(spark.createDataFrame([], MESSAGES)).count() == 0


def test_hot_conversation_and_line(spark):
    sent = [(1, i, "a", "same line\nown " + str(i)) for i in range(300)] + [(2, 0, "b", "> same line\nx")]
    got = {(r.conv_id, r.turn): r for r in quotes.conversations(spark.createDataFrame(sent, MESSAGES)).collect()}
    assert len(got) == 301 and got[1, 299].depth == 299 and got[2, 0].n_linked == 1


@pytest.mark.parametrize("text", ["plain", "two\nlines", "a\n\nb"])
def test_mail_round_trip(spark, text):
    sent = [(1, i, "a", f"{text} {i}") for i in range(5)]
    df = spark.createDataFrame(sent, MESSAGES)
    got = quotes.conversations(quotes.as_mail(df))
    assert rows(got, "conv_id", "turn", "role", "text") == sorted(sent, key=str)
