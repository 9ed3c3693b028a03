"""SentencePiece encoding and decoding: Viterbi over batches of words of equal length.

No piece goes on after a space that follows another character, so a text is cut into words
that begin with their spaces, and each distinct word of a batch is encoded once. Words of
one length advance together, position by position: hashes of all their substrings that end
there probe the sorted hashes of the pieces of that length, and maxima over the lengths
leave a score and a backpointer.

A unigram model maximizes the sum of piece scores. A byte-pair model has an encoding in
which the last piece of every prefix is the one that, with the last piece of the rest,
is itself the encoding of the two (merges never cross a border that stays); so there a
step is allowed only for such pairs, and the maximum is over what is allowed. Both give
the ids that the library gives for the same model file.

Words longer than LONG_WORD take the same steps one at a time, as few share a length.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from functools import lru_cache

from pyspark.sql import DataFrame

from ledgerloom.llm.common import CACHE_ENTRIES, documents, pick, shrink

SPACE = "▁"
LONG_WORD = 48
#: Words of the texts whose new words are encoded together; about 50 MB.
GROUP_WORDS = 500_000
#: Words that advance together at most.
TOGETHER = 8192
#: Places for known pairs of pieces, a power of two; a pair may push another out.
PAIR_PLACES = 1 << 21
BASE = 0x9E3779B97F4A7C15
UNIGRAM, BYTE_PAIR = 1, 2


class Pieces:
    """A model file's pieces, and the words encoded so far."""

    def __init__(self, path: str | None = None) -> None:
        import numpy as np
        from sentencepiece import sentencepiece_model_pb2 as proto

        if path is None:
            import public_tokenizers

            path = public_tokenizers.path("piece_bpe_32k.model")
        with open(path, "rb") as file:
            model = proto.ModelProto.FromString(file.read())
        self.kind = model.trainer_spec.model_type
        norm = model.normalizer_spec
        if self.kind not in (UNIGRAM, BYTE_PAIR) or norm.precompiled_charsmap:
            raise ValueError("only unigram and byte-pair models without normalization")
        if norm.remove_extra_whitespaces or not norm.escape_whitespaces:
            raise ValueError("only models that keep white space")
        if not model.trainer_spec.byte_fallback:
            raise ValueError("only models with a piece for every byte")
        self.prefix = SPACE if norm.add_dummy_prefix else ""

        kinds = proto.ModelProto.SentencePiece
        self.score: dict[str, float] = {}
        self.id: dict[str, int] = {}
        self.bytes = [0] * 256
        self.out: list[bytes] = []
        for i, piece in enumerate(model.pieces):
            text = piece.piece
            if piece.type == kinds.BYTE:
                self.bytes[int(text[3:5], 16)] = i
                self.out.append(bytes([int(text[3:5], 16)]))
            elif piece.type == kinds.NORMAL:
                self.id[text], self.score[text] = i, piece.score
                self.out.append(text.replace(SPACE, " ").encode())
            elif piece.type == kinds.UNKNOWN:
                self.out.append(model.trainer_spec.unk_surface.encode())
            elif piece.type == kinds.CONTROL:
                self.out.append(b"")
            else:
                raise ValueError(f"pieces of type {piece.type} are not known")
        if any(SPACE in text.lstrip(SPACE) for text in self.id):
            raise ValueError("a piece goes on after a space")

        self.text = {i: text for text, i in self.id.items()}
        self.size = len(model.pieces)
        self.scores = np.full(self.size, -np.inf)
        self.scores[list(self.id.values())] = list(self.score.values())
        self.unknown = min(self.score.values()) - 10
        self.longest = max(map(len, self.id))
        self.keys: list[tuple] = [(None, None)]
        self.powers = [np.uint64(pow(BASE, n, 1 << 64)) for n in range(self.longest + 1)]
        for n in range(1, self.longest + 1):
            own = [text for text in self.id if len(text) == n]
            hashes = self._prefixes(own, n)[:, n] if own else np.zeros(0, "u8")
            order = hashes.argsort()
            ids = np.array([self.id[text] for text in own], "i8")
            self.keys.append((hashes[order], ids[order]))
        self.pair_keys = np.full(PAIR_PLACES, -(1 << 62), "i8")
        self.pair_fits = np.zeros(PAIR_PLACES, bool)
        self.packed = [i.to_bytes(4, "little") for i in range(self.size)]
        self.words: dict[str, bytes] = {}

    def _prefixes(self, words: Sequence[str], n: int):
        """Hashes of all beginnings of words of ``n`` characters."""
        import numpy as np

        codes = np.frombuffer("".join(words).encode("utf-32-le"), "<u4").reshape(-1, n)
        found = np.zeros((len(words), n + 1), "u8")
        for i in range(n):
            found[:, i + 1] = found[:, i] * np.uint64(BASE) + (codes[:, i] + np.uint64(1))
        return found

    def _merged(self, text: str) -> list[str]:
        """A short text by merges: the best-scored pair first, of equal ones the first."""
        parts, score = list(text), self.score
        while len(parts) > 1:
            best, at = None, -1
            for i in range(len(parts) - 1):
                s = score.get(parts[i] + parts[i + 1])
                if s is not None and (best is None or s > best):
                    best, at = s, i
            if best is None:
                break
            parts[at : at + 2] = [parts[at] + parts[at + 1]]
        return parts

    def _pair(self, key: int) -> bool:
        """True if a piece may follow another (-1: a character without a piece)."""
        left, right = divmod(key, self.size)
        wanted = [self.text[i] for i in (left, right) if i >= 0]
        return self._merged("".join(wanted)) == wanted

    def _allowed(self, left, right):
        """The same for arrays of left and right pieces, with a table of known pairs."""
        import numpy as np

        keys = left * self.size + right
        place = (keys * 0x5851F42D4C957F2D >> 20) & (PAIR_PLACES - 1)
        new = np.flatnonzero(self.pair_keys[place] != keys)
        fits = self.pair_fits[place]
        if len(new):
            unknown, at = np.unique(keys[new], return_inverse=True)
            found = np.array([self._pair(int(k)) for k in unknown], bool)[at]
            fits[new] = found
            # of pairs with one place the last one written stays, key and value alike
            order = np.argsort(keys[new], kind="stable")
            spot, first = np.unique(place[new][order], return_index=True)
            self.pair_keys[spot] = keys[new][order][first]
            self.pair_fits[spot] = found[order][first]
        return fits

    def together(self, words: Sequence[str]) -> list[list[int]]:
        """Piece numbers (-1: a character without one) of words of one length."""
        import numpy as np

        n, count = len(words[0]), len(words)
        hashes = self._prefixes(words, n)
        best = np.full((count, n + 1), -np.inf)
        best[:, 0] = 0
        back = np.zeros((count, n + 1), "i8")
        last = np.full((count, n + 1), -1, "i8")
        for end in range(1, n + 1):
            rows, sizes, pieces = [], [], []
            for size in range(1, min(self.longest, end) + 1):
                keys, ids = self.keys[size]
                if not len(keys):
                    continue
                found = hashes[:, end] - hashes[:, end - size] * self.powers[size]
                at = np.minimum(keys.searchsorted(found), len(keys) - 1)
                row = np.flatnonzero(keys[at] == found)
                rows.append(row)
                sizes.append(np.full(len(row), size, "i8"))
                pieces.append(ids[at[row]])
            row, size, piece = map(np.concatenate, (rows, sizes, pieces))
            # a character without a piece stands alone
            bare = np.ones(count, bool)
            bare[rows[0]] = False
            back[bare, end] = 1
            if self.kind == UNIGRAM:
                best[bare, end] = best[bare, end - 1] + self.unknown
                value = best[row, end - size] + self.scores[piece]
            else:
                fits = self._allowed(last[row, end - size], piece)
                row, size, piece = row[fits], size[fits], piece[fits]
                value = size.astype(float)
            np.maximum.at(best[:, end], row, value)
            # of equal scores the longest piece, which comes last
            top = value == best[row, end]
            back[row[top], end] = size[top]
            last[row[top], end] = piece[top]
        paths: list[list[int]] = [[] for _ in words]
        for w, (steps, pieces) in enumerate(zip(back.tolist(), last.tolist())):
            end = n
            while end:
                paths[w].append(pieces[end])
                end -= steps[end]
            paths[w].reverse()
        return paths

    def alone(self, word: str) -> list[int]:
        """The same for one long word."""
        none, known = float("-inf"), {}
        best, back, last = [0.0], [0], [-1]
        for end in range(1, len(word) + 1):
            top, step, chosen = none, 0, -1
            for size in range(1, min(self.longest, end) + 1):
                piece = self.id.get(word[end - size : end], -1)
                if piece < 0:
                    if size > 1:
                        continue
                    value = best[end - 1] + self.unknown if self.kind == UNIGRAM else 0.0
                elif self.kind == UNIGRAM:
                    value = best[end - size] + self.scores[piece]
                else:
                    key = last[end - size] * self.size + piece
                    if key not in known:
                        known[key] = self._pair(key)
                    value = size if known[key] else none
                if value >= top and value > none:
                    top, step, chosen = value, size, piece
            best.append(top)
            back.append(step)
            last.append(chosen)
        path, end = [], len(word)
        while end:
            path.append(last[end])
            end -= back[end]
        return path[::-1]

    def _ids(self, word: str, path: Sequence[int]) -> bytes:
        """Ids of a path; its pieces must spell the word, so no hash can have misled it."""
        if -1 not in path:
            if "".join(map(self.text.__getitem__, path)) == word:
                return b"".join(map(self.packed.__getitem__, path))
            return self._ids(word, self.alone(word))
        ids, at = [], 0
        for piece in path:
            text = self.text[piece] if piece >= 0 else word[at]
            if not word.startswith(text, at):
                return self._ids(word, self.alone(word))
            at += len(text)
            ids += [piece] if piece >= 0 else [self.bytes[b] for b in text.encode()]
        return b"".join(map(self.packed.__getitem__, ids))

    def learn(self, words: set[str]) -> None:
        """Encode words that are not known yet."""
        by_length: dict[int, list[str]] = {}
        for word in words:
            if len(word) <= LONG_WORD:
                by_length.setdefault(len(word), []).append(word)
            else:
                self.words[word] = self._ids(word, self.alone(word))
        for own in by_length.values():
            for at in range(0, len(own), TOGETHER):
                some = own[at : at + TOGETHER]
                for word, path in zip(some, self.together(some)):
                    self.words[word] = self._ids(word, path)

    def split(self, text: str) -> list[str]:
        """Words of a text: spaces and what follows them."""
        if not text:
            return []
        parts = (self.prefix + text.replace(" ", SPACE)).split(SPACE)
        words, spaces = ([parts[0]] if parts[0] else []), SPACE
        for part in parts[1:-1]:
            if part:
                words.append(spaces + part)
                spaces = SPACE
            else:
                spaces += SPACE
        return words + [spaces + parts[-1]] * (len(parts) > 1)

    def encode(self, texts: Sequence[str]) -> list[bytes]:
        """Ids of each text as little-endian unsigned 32-bit integers."""
        found: list[bytes] = []
        group: list[list[str]] = []
        size, known = 0, self.words
        for i, text in enumerate(texts):
            group.append(self.split(text))
            size += len(group[-1])
            if size > GROUP_WORDS or i == len(texts) - 1:
                new = {word for words in group for word in words if word not in known}
                if len(known) + len(new) > CACHE_ENTRIES:
                    shrink(known)
                    new = {word for words in group for word in words if word not in known}
                self.learn(new)
                found += [b"".join(map(known.__getitem__, words)) for words in group]
                group, size = [], 0
        return found

    def decode(self, ids: Sequence[int]) -> str:
        """The text of ids; bytes that are no UTF-8 become replacement characters."""
        text = b"".join(map(self.out.__getitem__, ids)).decode("utf-8", "replace")
        return text[1:] if self.prefix and text.startswith(" ") else text


@lru_cache(maxsize=1)
def loaded(path: str | None) -> Pieces:
    """A worker's pieces, which it keeps from task to task."""
    return Pieces(path)


def encode(df: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, ids (array of int) for every row of (doc_id, text).

    Null and empty texts have no ids; ids of repeated rows are repeated. ``path`` is a model
    file that every executor has.
    """

    def run(batches: Iterator) -> Iterator:
        import numpy as np
        import pyarrow as pa

        pieces = loaded(path)
        for batch in batches:
            found = pieces.encode(batch.column("text").to_pylist())
            ends = np.cumsum([0] + [len(x) // 4 for x in found])
            ids = pa.array(np.frombuffer(b"".join(found), "<i4"))
            lists = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), ids)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), lists], ["doc_id", "ids"])

    return documents(df).mapInArrow(run, "doc_id bigint, ids array<int>")


def decode(df: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, text for every row of (doc_id, ids); null or empty ids give an empty text."""

    def run(batches: Iterator) -> Iterator:
        import pyarrow as pa

        pieces = loaded(path)
        for batch in batches:
            texts = [pieces.decode(ids or ()) for ids in batch.column("ids").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.string())], ["doc_id", "text"]
            )

    rows = pick(df, ("doc_id", "bigint"), ("ids", "array<int>"))
    return rows.mapInArrow(run, "doc_id bigint, text string")


def digests(df: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_ids, ids_crc32 of every text, and whether decoding gives the text back.

    A text that has the space mark itself comes back with a space in its place.
    """

    def run(batches: Iterator) -> Iterator:
        from zlib import crc32

        import numpy as np
        import pyarrow as pa

        pieces = loaded(path)
        for batch in batches:
            texts = batch.column("text").to_pylist()
            rows = []
            for text, ids in zip(texts, pieces.encode(texts)):
                back = pieces.decode(np.frombuffer(ids, "<u4").tolist())
                rows.append((len(ids) // 4, crc32(ids), back == text.replace(SPACE, " ")))
            sizes, sums, same = zip(*rows) if rows else ((), (), ())
            columns = [pa.array(sizes, pa.int64()), pa.array(sums, pa.int64()), pa.array(same, pa.bool_())]
            names = ["doc_id", "n_ids", "ids_crc32", "round_trip"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns], names)

    schema = "doc_id bigint, n_ids bigint, ids_crc32 bigint, round_trip boolean"
    return documents(df).mapInArrow(run, schema)
