"""Toxicity of whole texts: a lexicon with misspellings, weighed by the words around.

The lexicon is learned from labelled documents: words, and beginnings of words, that toxic
documents hold far more often than others. Its trie is intersected with the Levenshtein
automata of its terms: a state is the set of trie nodes that a word may have reached with
their least edits. States and steps are made as words need them; there are few, as a word
that leaves the lexicon is soon in the dead state.

A match counts by its context: a window of words around it tells a quotation or a report
from abuse. A logistic regression over the counts gives the score. Labels serve only for
learning; language, source and id are never inputs.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator, Sequence
from dataclasses import dataclass, field

from pyspark.sql import DataFrame, functions as F

from ledgerloom.llm.common import CACHE_ENTRIES, documents, parts, pick, shrink
from ledgerloom.operators.slices import cut

WORD = re.compile(r"\w+")
#: Words before and after a match that are looked at.
WINDOW = 6
# Words by which a window is read, in the four languages of the documents.
REPORTING = frozenset(
    "said says wrote quote quoted called word term sagte schrieb nannte zitat wort "
    "dit écrit appelé citation mot dijo escribió llamó cita palabra".split()
)
ADDRESS = frozenset("you your youre du dich dein ihr tu te ton vous votre tú usted ustedes".split())
OPENING, CLOSING = "\"“„«‘", "\"”“»’"
#: Letters of the beginnings of words that are counted.
PREFIX = range(4, 11)

#: Weights before anything is learned: constant, any plain match, plain matches, misspelt
#: ones, quoted ones, those beside an address, weak terms, weak terms per 100 words.
#: Learning starts there and stays near where the labels say nothing.
PRIOR = (-3.0, 4.0, 1.0, 1.5, 0.3, 1.0, 0.0, 0.0)
PRIOR_STRENGTH = 1.0


def edits_allowed(term: str) -> int:
    """Edits up to which a word still counts as ``term``.

    A final * marks a beginning, which some letters must follow; it allows no edits, as
    beginnings are short and many words start nearly like them.
    """
    return 0 if len(term) < 5 or term.endswith("*") else 1 if len(term) < 9 else 2


class Lexicon:
    """A trie of terms, walked by words with up to the edits that each term allows."""

    def __init__(self, terms: Sequence[str], weak: Sequence[str] = ()) -> None:
        self.terms = [*terms, *weak]
        self.strong = len(terms)  # terms from there on are weak
        self.next: list[dict[str, int]] = [{}]
        self.end: list[tuple[int, bool] | None] = [None]  # term, and whether it is a beginning
        self.reach = [0]  # edits that some term below allows
        for t, term in enumerate(self.terms):
            node, most = 0, self._allowed(t)
            self.reach[0] = max(self.reach[0], most)
            for char in term.rstrip("*"):
                if char not in self.next[node]:
                    self.next[node][char] = len(self.next)
                    self.next.append({})
                    self.end.append(None)
                    self.reach.append(0)
                node = self.next[node][char]
                self.reach[node] = max(self.reach[node], most)
            self.end[node] = (t, term.endswith("*"))
        self.letters = {char for step in self.next for char in step}
        self.states: dict[frozenset, int] = {}
        self.members: list[dict[int, int]] = []
        self.steps: list[dict[str, int]] = []
        self.whole: list[tuple[int, int] | None] = []
        self.begun: list[tuple[int, int] | None] = []
        self.start = self._state({0: 0})
        self.known: dict[str, tuple[int, int] | None] = {}

    def _allowed(self, term: int) -> int:
        return edits_allowed(self.terms[term]) if term < self.strong else 0

    def _state(self, nodes: dict[int, int]) -> int:
        todo = list(nodes.items())
        while todo:  # a letter of the term may be missing from the word
            node, edits = todo.pop()
            for child in self.next[node].values():
                if edits < self.reach[child] and nodes.get(child, 99) > edits + 1:
                    nodes[child] = edits + 1
                    todo.append((child, edits + 1))
        key = frozenset(nodes.items())
        if key not in self.states:
            self.states[key] = len(self.members)
            self.members.append(nodes)
            self.steps.append({})
            ends: list[list] = [[], []]
            for node, edits in nodes.items():
                if self.end[node]:
                    term, begins = self.end[node]
                    if edits <= self._allowed(term):
                        ends[begins].append((edits, term))
            self.whole.append(min(ends[0], default=None))
            self.begun.append(min(ends[1], default=None))
        return self.states[key]

    def _step(self, state: int, char: str) -> int:
        nodes: dict[int, int] = {}

        def reached(node: int, edits: int) -> None:
            if edits <= self.reach[node] and edits < nodes.get(node, 99):
                nodes[node] = edits

        for node, edits in self.members[state].items():
            reached(node, edits + 1)  # a letter too many
            for letter, child in self.next[node].items():
                reached(child, edits + (letter != char))
        self.steps[state][char] = found = self._state(nodes)
        return found

    def match(self, word: str) -> tuple[int, int] | None:
        """(edits, term) of the term nearest to ``word``, or None."""
        if word in self.known:
            return self.known[word]
        state, best = self.start, None
        for char in word:
            # a beginning counts if a letter follows
            if self.begun[state] and (best is None or self.begun[state] < best):
                best = self.begun[state]
            if char not in self.letters:
                char = ""  # all other letters are alike
            step = self.steps[state].get(char)
            state = self._step(state, char) if step is None else step
            if not self.members[state]:
                break
        else:
            if self.whole[state] and (best is None or self.whole[state] < best):
                best = self.whole[state]
        if len(word) < 40:
            if len(self.known) >= CACHE_ENTRIES:
                shrink(self.known)
            self.known[word] = best
        return best


def features(text: str, lexicon: Lexicon) -> tuple[float, ...]:
    """The inputs of the score, in the order of PRIOR; without a match all but the first are 0."""
    text = text.lower()
    words = WORD.findall(text)
    if not any([lexicon.match(word) for word in set(words)]):
        return (1.0,) + (0.0,) * (len(PRIOR) - 1)
    plain = misspelt = quoted = addressed = weak = 0
    spans = [m.span() for m in WORD.finditer(text)]
    for i, word in enumerate(words):
        found = lexicon.match(word)
        if not found:
            continue
        if found[1] >= lexicon.strong:
            weak += 1
            continue
        before, after = words[max(0, i - WINDOW) : i], words[i + 1 : i + 1 + WINDOW]
        left = text[spans[max(0, i - WINDOW)][0] : spans[i][0]]
        right = text[spans[i][1] : spans[min(len(words) - 1, i + WINDOW)][1] + 1]
        # an open quotation mark before, one that closes it after
        marks = [c for c in left if c in OPENING + CLOSING]
        within = len(marks) % 2 == 1 and any(c in CLOSING for c in right)
        if within or REPORTING.intersection(before[-3:]):
            quoted += 1
            continue
        if found[0]:
            misspelt += 1
        else:
            plain += 1
        addressed += bool(ADDRESS.intersection(before[-2:] + after[:2]))
    counts = (plain, misspelt, quoted, addressed, weak)
    return (1.0, float(plain > 0), *(math.log1p(n) for n in counts), 100 * weak / len(words))


@dataclass
class Model:
    """What is learned: at most MAX_TERMS terms of either kind and a weight per input."""

    terms: list[str] = field(default_factory=list)
    weak: list[str] = field(default_factory=list)
    weights: tuple[float, ...] = PRIOR

    def score(self, inputs: Sequence[float]) -> float:
        total = sum(w * x for w, x in zip(self.weights, inputs))
        return 1 / (1 + math.exp(-max(-30.0, min(30.0, total))))


MAX_TERMS = 400
#: Log-odds from which a term marks a text by itself, or together with others.
STRONG, WEAK = 3.0, 1.2


def pick_terms(
    counts: dict[str, tuple[int, int]], toxic: int, clean: int, support: int, odds: float
) -> list[str]:
    """Terms from (toxic documents, others) per word and per beginning (with a final *).

    A term must be in ``support`` toxic documents and have log-odds of ``odds``. Of the
    beginnings of one word the shortest such is taken, made as long as it goes without
    losing a twentieth of its documents; a whole word is taken in its place by the same rule.
    """
    def pure(term: str) -> bool:
        t, c = counts[term]
        gain = math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1))
        return t >= support and gain >= odds

    fine = {term for term in counts if pure(term)}
    longer: dict[str, list[str]] = {}
    for term in fine:
        stem = term.rstrip("*")
        for n in PREFIX:
            if n <= len(stem):
                longer.setdefault(stem[:n], []).append(term)
    found = []
    for term in sorted(fine):
        stem = term.rstrip("*")
        if any(f"{stem[:n]}*" in fine for n in PREFIX if n < len(stem)):
            continue
        if not term.endswith("*"):
            if f"{stem}*" not in fine:
                found.append(term)
            continue
        near = [x for x in longer[stem] if counts[x][0] >= 0.95 * counts[term][0]]
        found.append(max(near, key=lambda x: (not x.endswith("*"), len(x), x)))
    return sorted(set(found), key=lambda x: (-counts[x][0], x))[:MAX_TERMS]


def fit(rows: Sequence[tuple[Sequence[float], int]]) -> tuple[float, ...]:
    """Weights of a logistic regression that is held to PRIOR, by Newton's steps."""
    import numpy as np

    weights = prior = np.array(PRIOR)
    if rows:
        x = np.array([r[0] for r in rows])
        y = np.array([r[1] for r in rows], float)
        for _ in range(50):
            p = 1 / (1 + np.exp(-np.clip(x @ weights, -30, 30)))
            slope = x.T @ (p - y) + PRIOR_STRENGTH * (weights - prior)
            bend = (x * (p * (1 - p))[:, None]).T @ x + PRIOR_STRENGTH * np.eye(len(prior))
            step = np.linalg.solve(bend, slope)
            weights = weights - np.clip(step, -2, 2)
            if np.abs(step).max() < 1e-9:
                break
    return tuple(map(float, weights))


def held_out(doc_id):
    """True for the fifth of ids that are never learned from."""
    remainder = F.crc32(doc_id.cast("string").cast("binary")) % 5
    return F.coalesce(remainder == 0, F.lit(False))


def _terms_of(words: set[str]) -> set[str]:
    """Words and their beginnings, each of which is to be counted once a document."""
    found = {word for word in words if len(word) > 2}
    for n in PREFIX:
        found.update([f"{word[:n]}*" for word in words if len(word) > n])
    return found


def learn(docs: DataFrame, labels: DataFrame, sample_rows: int = 20_000) -> Model:
    """A model from (doc_id, text) and (doc_id, toxic), without the held-out ids.

    At most ``sample_rows`` labelled documents, the least by a hash of their ids, are read;
    of documents alike (the same text, or the same least hash of a run of five words) one
    is. Null labels and ids are left out; of several labels of one id the greater counts.
    Without labels the lexicon is empty and the weights are those of PRIOR.
    """
    marks = pick(labels, ("doc_id", "bigint"), ("toxic", "int"))
    marks = marks.where("doc_id IS NOT NULL AND toxic IS NOT NULL").where(~held_out(F.col("doc_id")))
    chosen = (
        marks.groupBy("doc_id")
        .agg(F.max("toxic").alias("toxic"))
        .orderBy(F.xxhash64("doc_id"), "doc_id")
        .limit(sample_rows)
    )

    def keyed(batches: Iterator) -> Iterator:
        from zlib import crc32

        import pyarrow as pa

        for batch in parts(batches):
            keys = []
            for text in batch.column("text").to_pylist():
                words = text.lower().split()
                runs = [" ".join(words[i : i + 5]) for i in range(max(1, len(words) - 4))]
                keys.append(min(crc32(run.encode()) for run in runs))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(keys, pa.int64())], [*batch.schema.names, "like"]
            )

    both = documents(docs).join(F.broadcast(chosen), "doc_id").select("doc_id", "text", "toxic")
    alike = both.mapInArrow(keyed, "doc_id bigint, text string, toxic int, like bigint")
    sample = cut(alike.dropDuplicates(["like", "toxic"]).select("text", "toxic"))
    sizes = {r.toxic: r.n for r in sample.groupBy("toxic").agg(F.count("*").alias("n")).collect()}
    toxic = sum(n for label, n in sizes.items() if label)
    clean = sizes.get(0, 0)
    support = max(4, round(0.004 * toxic))

    def count(wanted: set[str] | None):
        def run(batches: Iterator) -> Iterator:
            import pyarrow as pa

            for batch in parts(batches):
                counts: Counter = Counter()
                for text in batch.column("text").to_pylist():
                    terms = _terms_of(set(WORD.findall(text.lower())))
                    counts.update(terms if wanted is None else terms & wanted)
                yield pa.RecordBatch.from_arrays(
                    [pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())],
                    ["term", "n"],
                )

        return run

    def totals(rows: DataFrame, wanted: set[str] | None) -> DataFrame:
        found = rows.select("text").mapInArrow(count(wanted), "term string, n bigint")
        return found.groupBy("term").agg(F.sum("n").alias("n")).where(F.col("n") >= 1)

    # the sample bounds both lists: terms of `support` of its toxic documents are few
    often = totals(sample.where("toxic <> 0"), None).where(F.col("n") >= support)
    in_toxic = {r.term: r.n for r in often.orderBy(F.desc("n"), "term").limit(50_000).collect()}
    in_clean = {r.term: r.n for r in totals(sample.where("toxic = 0"), set(in_toxic)).collect()}
    counts = {term: (n, in_clean.get(term, 0)) for term, n in in_toxic.items()}
    terms = pick_terms(counts, toxic, clean, support, STRONG)
    # a beginning that is hardly more than one strong word would take its misspellings
    words = [term for term in terms if not term.endswith("*")]
    rest = {
        term: n
        for term, n in counts.items()
        if not any(term.startswith(strong.rstrip("*")) for strong in terms)
        and not any(
            word.startswith(term.rstrip("*")) and counts[word][0] >= 0.9 * n[0] for word in words
        )
    }
    weak = pick_terms(rest, toxic, clean, max(support, toxic // 50), WEAK)

    def inputs(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lexicon = Lexicon(terms, weak)
        for batch in parts(batches):
            found = [features(text, lexicon) for text in batch.column("text").to_pylist()]
            kind = pa.list_(pa.float64())
            yield pa.RecordBatch.from_arrays(
                [pa.array(found, kind), batch.column("toxic")], ["inputs", "toxic"]
            )

    rows = sample.mapInArrow(inputs, "inputs array<double>, toxic int").collect()
    return Model(terms, weak, fit([(r.inputs, int(r.toxic != 0)) for r in rows]))


def score(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, held_out, score, predicted of every row of (doc_id, text).

    Null and empty texts have no match and the score of one without; repeated rows are
    scored each; an empty table gives no rows.
    """

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lexicon = Lexicon(model.terms, model.weak)
        for batch in parts(batches):
            scores = [
                model.score(features(text, lexicon)) for text in batch.column("text").to_pylist()
            ]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores, pa.float64())], ["doc_id", "score"]
            )

    scored = documents(docs).mapInArrow(run, "doc_id bigint, score double")
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"),
    )


def without_toxic(docs: DataFrame, model: Model) -> DataFrame:
    """The rows of ``docs``, with all their columns, that the model does not call toxic."""
    schema = docs.schema

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        lexicon = Lexicon(model.terms, model.weak)
        for batch in parts(batches):
            texts = batch.column("text").to_pylist()
            kept = [model.score(features(text or "", lexicon)) < 0.5 for text in texts]
            yield batch.filter(pa.array(kept, pa.bool_()))

    return docs.mapInArrow(run, schema)
