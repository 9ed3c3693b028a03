"""SentencePiece, packing and token totals."""

import base64
import re
from collections import Counter
from zlib import crc32

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
from sentencepiece import sentencepiece_model_pb2 as proto
from tokenizers import Tokenizer

from ledgerloom.llm import packing, queries, sentencepieces, token_rollups
from ledgerloom.llm.common import BytePairs, token_counts
from tests.llm.helpers import AWKWARD, DOCUMENTS, clashing, documents, rows

PIECES = public_tokenizers.path("piece_bpe_32k.model")
TEXTS = [
    "", " ", "   ", "a", " a  b ", "Hello  world\n x", "a▁b ▁", "\t\n", "日本\u0000", "ﬁ １ 😀x😀",
    "中文文本测试" * 20, "é" * 90, "the " * 60, "x" * 200, "the quick brown fox, 12345.67!",
]


@pytest.fixture(scope="module")
def pieces():
    return sentencepieces.Pieces()


def test_ids_are_those_of_the_library(pieces):
    library = sentencepiece.SentencePieceProcessor(model_file=PIECES)
    random = np.random.default_rng(5)
    parts = list(pieces.id) + [" ", "  ", "\n", "ж", "日"]
    texts = TEXTS + ["".join(random.choice(parts, random.integers(1, 12))) for _ in range(2000)]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in pieces.encode(texts)]
    assert got == [library.encode(text) for text in texts]
    assert [pieces.decode(ids) for ids in got] == [library.decode(ids) for ids in got]


def test_long_words_take_the_same_steps(pieces):
    words = [word for word in pieces.split(" ".join(TEXTS)) if len(word) <= 40]
    for word in words:
        assert pieces.together([word]) == [pieces.alone(word)]


def test_unigram_model_finds_the_best_sum(tmp_path):
    with open(PIECES, "rb") as file:
        model = proto.ModelProto.FromString(file.read())
    model.trainer_spec.model_type = sentencepieces.UNIGRAM
    path = tmp_path / "unigram.model"
    path.write_bytes(model.SerializeToString())
    pieces = sentencepieces.Pieces(str(path))
    library = sentencepiece.SentencePieceProcessor(model_file=str(path))
    # the library's lattice; it adds up single floats, so short texts only are the same
    texts = ["hello", "the cat", "unbelievable", "naïve", "aaaa", "internationalization"]
    got = [np.frombuffer(ids, "<u4").tolist() for ids in pieces.encode(texts)]
    assert got == [library.nbest_encode(text, nbest_size=2)[0] for text in texts]

    def best(word):
        if not word:
            return 0.0
        found = [best(word[1:]) + pieces.unknown] if word[0] not in pieces.id else []
        for n in range(1, min(len(word), pieces.longest) + 1):
            if word[:n] in pieces.id:
                found.append(pieces.score[word[:n]] + best(word[n:]))
        return max(found)

    for word in ("▁there", "▁abab", "▁ñandú"):
        path_ = pieces.together([word])[0]
        total = sum(pieces.scores[p] if p >= 0 else pieces.unknown for p in path_)
        assert total == pytest.approx(best(word))


def test_encode_and_decode_frames(spark):
    df = clashing(documents(spark))
    encoded = sentencepieces.encode(df)
    texts = sentencepieces.decode(encoded)
    assert rows(texts, "doc_id", "text") == rows(df.na.fill("", ["text"]), "doc_id", "text")
    told = sentencepieces.digests(df).collect()
    assert all(r.round_trip for r in told) and len(told) == len(AWKWARD)
    assert {r.n_ids for r in told if r.doc_id in (2, 3)} == {0}
    assert sentencepieces.digests(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_byte_pairs_are_those_of_the_tokenizer():
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    tokenizer.encode_special_tokens = True
    pairs = BytePairs()
    odd = [" a", "a ", "a  b", "a \n b", "a\n b", " a  b", "it's we'll", "<|endoftext|> x", "a　 b"]
    for text in TEXTS + odd:
        got = np.frombuffer(pairs.text(text), "<u4").tolist()
        assert got == tokenizer.encode(text, add_special_tokens=False).ids, repr(text)


def test_added_tokens_have_their_ids(spark):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    pairs, end = BytePairs(), "<|endoftext|>"
    odd = [f"a {end} x", end, f"{end}{end}", f" {end}  b\n", f"a{end}b <|endoftext| >", f"é {end}\n\n {end} it's "]
    want = [tokenizer.encode(text, add_special_tokens=False).ids for text in TEXTS + odd]
    assert want[len(TEXTS)] == [64, 220, 50256, 2124]
    assert [np.frombuffer(pairs.ids(text), "<u4").tolist() for text in TEXTS + odd] == want
    docs = documents(spark, [(i, text, "en", "a", 0) for i, text in enumerate(odd)])
    ids = {i: np.array(w + [1], "<u4") for i, w in enumerate(want[len(TEXTS) :])}
    packed = {r.doc_id: (r.doc_tokens, r.ids_crc32) for r in packing.pack(docs).collect()}
    assert packed == {i: (len(w), crc32(w.tobytes())) for i, w in ids.items()}
    assert {r.doc_id: r.tokens for r in token_counts(docs).collect()} == {i: len(w) - 1 for i, w in ids.items()}


def test_plan_holds_every_piece():
    random = np.random.default_rng(3)
    for _ in range(50):
        lengths = random.choice([64, 32, 16, 8, *range(1, 8)], random.integers(1, 200))
        counts = {int(n): int(c) for n, c in zip(*np.unique(lengths, return_counts=True))}
        plan = packing.packing_plan(counts, 64)
        placed: dict = {}
        for copies, pattern in plan:
            assert copies > 0 and sum(pattern) <= 64
            for length in pattern:
                placed[length] = placed.get(length, 0) + copies
        assert placed == counts and len(plan) <= 3 * len(counts)
        waste = sum(copies * (64 - sum(pattern)) for copies, pattern in plan)
        assert waste < 64 + 8 * len(plan)


def test_cut_points_cover_a_document():
    for tokens in (1, 2, 255, 256, 257, 2047, 2048, 2049, 10_000):
        pieces = packing.cut_points(tokens, 2048, (1024, 512, 256))
        assert [start for start, _ in pieces] == np.cumsum([0] + [n for _, n in pieces])[:-1].tolist()
        assert sum(n for _, n in pieces) == tokens


def test_packing(spark):
    df = clashing(documents(spark))
    got = packing.pack(df).toPandas()
    pairs = BytePairs()
    for (doc_id, text, *_), copies in {row: AWKWARD.count(row) for row in AWKWARD}.items():
        ids = np.append(np.frombuffer(pairs.text(text or ""), "<u4"), 1).astype("<u4")
        own = got[got.doc_id == doc_id] if doc_id else got[got.doc_id.isna()]
        assert own.length.sum() == copies * len(ids)
        for piece in own.itertuples():
            part = ids[piece.start : piece.start + piece.length]
            assert crc32(part.tobytes()) == piece.ids_crc32 and piece.doc_tokens == len(ids)
    got = got.sort_values(["sequence_id", "offset"])
    assert (got.groupby("sequence_id").length.cumsum() - got.length == got.offset).all()
    assert (got.groupby("sequence_id").length.sum() == got.groupby("sequence_id").sequence_tokens.first()).all()
    assert got.sequence_tokens.max() <= 2048
    assert packing.pack(spark.createDataFrame([], DOCUMENTS)).count() == 0


def test_steps_cost_alike(spark):
    texts = [(i, "word " * (50 + 37 * i % 900), "en", "a", 0) for i in range(400)]
    got = packing.pack(documents(spark, texts), step_size=16).toPandas()
    cost = got.groupby("step_id").length.apply(lambda n: (n.astype(float) ** 2).sum())
    assert len(cost) > 3 and cost.max() < 1.2 * cost.min()


CHANGES = "op string, source string, lang string, tokenizer_version string, tokens bigint, old_tokens bigint"


def test_rollup_adds_signed_batches_once(spark, tmp_path):
    rollup = token_rollups.TokenRollup(spark, str(tmp_path / "rollup"))
    assert rollup.totals().count() == 0

    def frame(*changes):
        return spark.createDataFrame(list(changes), CHANGES)

    first = frame(("insert", "a", "en", "v1", 10, None), ("insert", "a", "en", "v1", 5, None),
                  ("insert", None, "en", "v1", None, None), ("insert", "b", "de", "v1", 7, None))
    assert rollup.commit("1", first)
    assert not rollup.commit("1", first)
    assert rollup.commit("2", frame(("delete", "b", "de", "v1", 7, None), ("revise", "a", "en", "v1", 8, 5)))
    assert rollup.commit("3", frame())
    want = [("a", "en", "v1", 2, 18), (None, "en", "v1", 1, 0)]
    assert rows(rollup.totals()) == sorted(want, key=str)
    # a crash before the rename leaves a staging folder that nobody reads
    token_rollups.signed(first).write.parquet(f"{rollup.folder}/staging/crashed")
    assert rows(rollup.totals()) == sorted(want, key=str)
    # another writer's commit of the same batch is not replaced
    token_rollups.signed(first).write.parquet(f"{rollup.folder}/staging/late")
    assert not rollup._rename(f"{rollup.folder}/staging/late", rollup._home("1"))
    assert rows(rollup.totals()) == sorted(want, key=str)


def test_compaction_keeps_totals_and_batch_ids(spark, tmp_path):
    rollup = token_rollups.TokenRollup(spark, str(tmp_path / "rollup"))
    assert rollup.compact() == 0
    for batch in range(5):
        rollup.commit(str(batch), spark.createDataFrame([("insert", "a", None, "v1", batch, None)], CHANGES))
        if batch in (1, 3):
            assert rollup.compact() == 2 and rollup.compact() == 0
    assert rows(rollup.totals()) == [("a", None, "v1", 5, 10)]
    for batch in range(5):
        assert not rollup.commit(str(batch), spark.createDataFrame([("insert", "a", None, "v1", 99, None)], CHANGES))
    # folders that a compaction which broke off has left are not read
    token_rollups.signed(spark.createDataFrame([("insert", "a", None, "v1", 7, None)], CHANGES)).write.parquet(rollup._home("0"))
    assert rows(rollup.totals()) == [("a", None, "v1", 5, 10)]
    assert rollup.compact() == 1 and rows(rollup.totals()) == [("a", None, "v1", 5, 10)]


@pytest.mark.parametrize("data", ["given", "awkward"])
def test_token_totals_equal_brute_force(spark, tmp_path, data):
    """Vocabularies of the libraries over all documents, copies taken off, white space squeezed."""
    if data == "given":
        folder = "/root/testdata/sf0.001"
        docs = [(r.doc_id, r.text, r.lang, r.source) for r in spark.read.parquet(f"{folder}/documents.parquet").collect()]
    else:
        folder = str(tmp_path)
        some = [*AWKWARD, (20, "a  b\n\nc <|endoftext|> d", "en", "b", 0), (21, "a  b\n\nc <|endoftext|> d", "de", None, 0)]
        clashing(documents(spark, some)).write.parquet(f"{folder}/documents.parquet")
        docs = [r[:4] for r in some]
    main = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    with open(public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, lines)}
    multi = tiktoken.Encoding("multi", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})
    count = {
        "byte_bpe_50k": lambda t: len(main.encode(t, add_special_tokens=False).ids),
        "byte_bpe_multi_50k": lambda t: len(multi.encode_ordinary(t)),
    }
    least: dict = {}
    for doc_id, text, *_ in docs:
        known = [x for x in (least.get(text or ""), doc_id) if x is not None]
        least[text or ""] = min(known, default=None)
    want = Counter()
    sizes = Counter()
    for doc_id, text, lang, source in docs:
        if doc_id == least[text or ""]:
            for version, n in count.items():
                slim = re.sub("[ \t\n\r\f]+", " ", text or "").strip(" ")
                want[source, lang, version] += n(slim)
                sizes[source, lang, version] += 1
    got = rows(queries.op2_token_counts(spark, folder), "source", "lang", "tokenizer_version", "docs", "tokens")
    assert got == sorted(((*k, sizes[k], want[k]) for k in sizes), key=str)


def test_rollup_refuses_unknown_changes(spark, tmp_path):
    rollup = token_rollups.TokenRollup(spark, str(tmp_path / "rollup"))
    with pytest.raises(Exception, match="unknown op"):
        rollup.commit("1", spark.createDataFrame([("move", "a", "en", "v1", 1, None)], CHANGES))
    assert not rollup.committed("1")


def test_token_counts(spark):
    counted = rows(token_counts(documents(spark)))
    pairs = BytePairs()
    assert counted == sorted(((r[0], len(pairs.text(r[1] or "")) // 4) for r in AWKWARD), key=str)
