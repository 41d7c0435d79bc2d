"""SentencePiece encoding by a Viterbi pass that words with equal beginnings share.

The distinct marked words of a batch are sorted, which puts the nodes of their
trie into depth-first order: each word goes on from the forward scores of the
letters it has in common with the word before. A node's score is the best over
all pieces that end there, of the score at the piece's start plus the piece's.

For a byte-pair model the lattice only has the steps that its merges allow: a
piece may follow another if merging their letters gives back these two. Then
one path is left to every node, and it is the one that the merges make. Letters
without a piece become byte pieces.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, BooleanType, IntegerType, LongType, StructField, StructType

from haulmart.llm.shared import Remembered

MARK = "▁"
# Encoded words that a worker remembers between batches, and texts that it encodes at a time.
REMEMBERED = 600_000
TEXTS = 1_000
# White runs go with the word after them; no piece spans the end of a word or a
# line break, which has no piece of its own.
_UNIT = re.compile(f"{MARK}*[^{MARK}\n]+|\n|{MARK}+")


def model_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("piece_bpe_32k.model")


class Pieces:
    """A byte-pair SentencePiece model with byte fallback, read from its file."""

    def __init__(self, path: str) -> None:
        import sentencepiece

        model = sentencepiece.SentencePieceProcessor(model_file=path)
        self.ids: dict[str, int] = {}
        self.scores: dict[str, float] = {}
        self.bytes: list[int] = [0] * 256
        self.surface: list[bytes] = []
        for i in range(model.get_piece_size()):
            piece = model.id_to_piece(i)
            if model.is_byte(i):
                self.bytes[int(piece[3:5], 16)] = i
                self.surface.append(bytes([int(piece[3:5], 16)]))
            elif model.is_control(i) or model.is_unknown(i) or model.is_unused(i):
                self.surface.append(b"")
            else:
                self.ids[piece], self.scores[piece] = i, model.get_score(i)
                self.surface.append(piece.replace(MARK, " ").encode())
        self.tails = {p[k:] for p in self.ids for k in range(1, len(p))}
        self._follows: dict[tuple[str, str], bool] = {}
        self._remembered = Remembered(REMEMBERED)

    def merged(self, letters: Iterable[str]) -> list[str]:
        """What the merges make of a row of letters: best score first, leftmost of equal."""
        row = list(letters)
        while len(row) > 1:
            best, at = None, -1
            for i in range(len(row) - 1):
                score = self.scores.get(row[i] + row[i + 1])
                if score is not None and (best is None or score > best):
                    best, at = score, i
            if best is None:
                break
            row[at : at + 2] = [row[at] + row[at + 1]]
        return row

    def follows(self, a: str, b: str) -> bool:
        known = self._follows.get((a, b))
        if known is None:
            known = self._follows[a, b] = self.merged(a + b) == [a, b]
        return known

    def encode_words(self, words: Iterable[str]) -> Iterator[tuple[str, list[str]]]:
        """(word, pieces) of distinct words, walked depth first through their trie."""
        scores, tails, follows, known = self.scores, self.tails, self.follows, self._follows.get
        forward: list[float] = [0.0]
        last: list[str] = [""]
        before = ""
        for word in sorted(words):
            shared, top = 0, min(len(word), len(before))
            while shared < top and word[shared] == before[shared]:
                shared += 1
            del forward[shared + 1 :], last[shared + 1 :]
            for end in range(shared + 1, len(word) + 1):
                start = end - 1
                piece = word[start:end]
                ending = [piece]
                # Nothing longer ends here if no piece ends like this.
                while start and piece in tails:
                    start -= 1
                    piece = word[start:end]
                    if piece in scores:
                        ending.append(piece)
                while ending:
                    piece = ending.pop()
                    start = end - len(piece)
                    if start:
                        allowed = known((last[start], piece))
                        if not (follows(last[start], piece) if allowed is None else allowed):
                            continue
                    # The merges leave one step into a node, so the first found is the best.
                    forward.append(forward[start] + scores.get(piece, 0.0))
                    last.append(piece)
                    break
            pieces, at = [], len(word)
            while at:
                pieces.append(last[at])
                at -= len(last[at])
            before = word
            yield word, pieces[::-1]

    def _packed(self, pieces: list[str]) -> bytes:
        out: list[int] = []
        for piece in pieces:
            known = self.ids.get(piece)
            if known is None:
                out += [self.bytes[b] for b in piece.encode("utf-8", "replace")]
            else:
                out.append(known)
        return np.array(out, "<i4").tobytes()

    def encode(self, texts: Iterable[str | None]) -> list[np.ndarray]:
        """Ids of whole texts; null like empty, without ids."""
        texts, out = list(texts), []
        for at in range(0, len(texts), TEXTS):
            cut = [_UNIT.findall(f" {t}".replace(" ", MARK)) if t else [] for t in texts[at : at + TEXTS]]
            new = self._remembered.unknown(cut)
            words = self._remembered.values
            for word, pieces in self.encode_words(new):
                words[word] = self._packed(pieces)
            out += [np.frombuffer(b"".join(map(words.__getitem__, units)), "<i4") for units in cut]
            self._remembered.trim()
        if len(self._follows) > 4 * REMEMBERED:
            self._follows.clear()
        return out

    def decode(self, ids: Iterable[int]) -> str:
        surface = self.surface
        text = b"".join(map(surface.__getitem__, ids)).decode("utf-8", "replace")
        return text.removeprefix(" ")


_models: dict[str, Pieces] = {}


def model(path: str) -> Pieces:
    """The model of a path, once per worker process."""
    if path not in _models:
        _models[path] = Pieces(path)
    return _models[path]


CHECKED = StructType([
    StructField("n_tokens", LongType()),
    StructField("ids_crc32", LongType()),
    StructField("round_trip", BooleanType()),
])


def encoder(path: str):
    """Column function from a text to its piece ids."""

    def encode(texts: pd.Series) -> pd.Series:
        return pd.Series(model(path).encode(texts), dtype=object)

    return F.pandas_udf(encode, ArrayType(IntegerType()))


def checker(path: str):
    """Column function from a text to the number and checksum of its ids.

    The ids are decoded again; ``round_trip`` says that this gave the text, in
    which the model does not tell the mark U+2581 from a space.
    """

    def check(texts: pd.Series) -> pd.DataFrame:
        pieces = model(path)
        rows = []
        for text, ids in zip(texts, pieces.encode(texts)):
            same = pieces.decode(ids.tolist()) == (text or "").replace(MARK, " ")
            rows.append((len(ids), zlib.crc32(ids.tobytes()), same))
        return pd.DataFrame(rows, columns=CHECKED.fieldNames())

    return F.pandas_udf(check, CHECKED)


def encoded(docs: DataFrame, path: str | None = None) -> DataFrame:
    """All columns of ``docs`` with ``token_ids`` and ``n_tokens``; those names are replaced.

    A null or empty text has no ids; repeated rows come out repeated.
    """
    ids = encoder(path or model_path())("text")
    return docs.withColumn("token_ids", ids).withColumn("n_tokens", F.size("token_ids").cast("long"))


def round_trips(docs: DataFrame, path: str | None = None) -> DataFrame:
    """doc_id, n_tokens, ids_crc32 (of little-endian 32-bit ids) and round_trip of each row.

    A null or empty text has no ids and makes the round trip.
    """
    checked = docs.select("doc_id", checker(path or model_path())("text").alias("x"))
    return checked.select("doc_id", *[f"x.{c}" for c in CHECKED.fieldNames()])
