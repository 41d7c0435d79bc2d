"""Token counts of the sections of a text, by where the tokens stand.

A document is encoded once, as a whole. The tokens' places are joined with the
sections' places: both are sorted intervals, so each token finds the sections
it touches by binary search. A token that crosses a border is allocated by an
explicit rule:

* ``first``: to the section of its first character,
* ``most``: to the section with most of its characters, the earlier of equals,
* ``parts``: to each section by the share of its characters.
"""

from __future__ import annotations

import base64
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

RULES = ("first", "most", "parts")


def ranks_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.tiktoken")


class Encoder:
    """A byte-level vocabulary and the number of bytes of each of its tokens."""

    def __init__(self, path: str) -> None:
        import public_tokenizers
        import tiktoken

        with open(path, "rb") as lines:
            pairs = (line.split() for line in lines)
            ranks = {base64.b64decode(token): int(rank) for token, rank in pairs}
        self._encoding = tiktoken.Encoding(
            "corpus", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={}
        )
        self._bytes = np.zeros(max(ranks.values()) + 1, np.int64)
        for token, rank in ranks.items():
            self._bytes[rank] = len(token)

    def spans(self, text: str) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of each token in characters; a token with part of a character has it all."""
        ids = np.array(self._encoding.encode_ordinary(text), np.int64)
        ends = np.cumsum(self._bytes[ids])
        starts = ends - self._bytes[ids]
        if len(text) == (ends[-1] if len(ends) else 0):
            return starts, ends
        data = np.frombuffer(text.encode("utf-8", "replace"), np.uint8)
        character = np.cumsum((data & 0xC0) != 0x80) - 1
        return character[starts], character[ends - 1] + 1


_encoders: dict[str, Encoder] = {}


def encoder(path: str) -> Encoder:
    """The encoder of a path, once per worker process."""
    if path not in _encoders:
        _encoders[path] = Encoder(path)
    return _encoders[path]


def lines(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Sections of a text: its lines, each with its line feed, so they leave no gap."""
    lengths = np.array([len(line) + 1 for line in text.split("\n")], np.int64)
    lengths[-1] -= 1
    if not lengths[-1]:
        lengths = lengths[:-1]
    ends = np.cumsum(lengths)
    return ends - lengths, ends


def attribute(
    token_starts: np.ndarray, token_ends: np.ndarray,
    starts: np.ndarray, ends: np.ndarray, rule: str,
) -> tuple[np.ndarray, np.ndarray, float]:
    """(tokens per section, crossing tokens per section, tokens of no section).

    Sections are in order; where one begins before the one before it ends, it
    counts from that end. Tokens that touch no section, or whose first
    character is in none under ``first``, belong to none; under ``parts`` only
    the share outside does.
    """
    if rule not in RULES:
        raise ValueError(f"rule must be one of {RULES}")
    tops = np.maximum.accumulate(ends) if len(ends) else ends
    starts = np.maximum(starts, np.r_[0, tops[:-1]]) if len(ends) else starts
    ends = np.maximum(ends, starts)
    low = np.searchsorted(ends, token_starts, "right")
    high = np.searchsorted(starts, token_ends, "left")
    touched = np.maximum(high - low, 0)
    token = np.repeat(np.arange(len(touched)), touched)
    section = np.repeat(low, touched) + np.arange(len(token)) - np.repeat(np.cumsum(touched) - touched, touched)
    inside = np.minimum(token_ends[token], ends[section]) - np.maximum(token_starts[token], starts[section])
    real = inside > 0
    token, section, inside = token[real], section[real], inside[real]
    length = (token_ends - token_starts)[token]
    n = len(starts)
    crossing = np.bincount(section[inside < length], minlength=n)
    if rule == "parts":
        weight = inside / length
        counts = np.bincount(section, weight, minlength=n)
        return counts, crossing, float(len(token_starts) - weight.sum())
    if rule == "first":
        chosen = starts[section] <= token_starts[token]
    else:
        # The longest share of each token, the earlier of equals: sorted last of the token.
        order = np.lexsort((-section, inside, token))
        last = np.r_[token[order][1:] != token[order][:-1], True][: len(order)]
        chosen = np.zeros(len(token), bool)
        chosen[order[last]] = True
    counts = np.bincount(section[chosen], minlength=n).astype(float)
    return counts, crossing, float(len(token_starts) - chosen.sum())


SCHEMA = "section long, start long, end long, n_tokens double, n_crossing long, n_outside double"


def section_tokens(
    docs: DataFrame,
    rule: str = "most",
    sections: Callable[[str], tuple[np.ndarray, np.ndarray]] = lines,
    path: str | None = None,
) -> DataFrame:
    """A row for each section of each document: doc_id, its place and its tokens.

    ``n_outside`` are the document's tokens of no section, told in its first
    row. A text without sections (null, empty) has one row with section null
    and no tokens of its own. Repeated rows come out repeated.
    """
    used = path or ranks_path()
    id_type = docs.schema["doc_id"].dataType.simpleString()

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        coder = encoder(used)
        for batch in batches:
            rows, columns = [], [[] for _ in range(6)]
            for i, text in enumerate(batch.column(1).to_pylist()):
                starts, ends = sections(text) if text else (np.empty(0, np.int64),) * 2
                token_starts, token_ends = coder.spans(text) if text else (starts, ends)
                counts, crossing, outside = attribute(token_starts, token_ends, starts, ends, rule)
                n = len(counts)
                rows += [i] * max(n, 1)
                for column, made in zip(columns, (
                    range(n), starts.tolist(), ends.tolist(), counts.tolist(), crossing.tolist(),
                    [outside] + [0.0] * (n - 1),
                )):
                    column += made if n else [outside if made == [outside] else None]
            types = (pa.int64(), pa.int64(), pa.int64(), pa.float64(), pa.int64(), pa.float64())
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(pa.array(rows, pa.int64())), *map(pa.array, columns, types)],
                ["doc_id", "section", "start", "end", "n_tokens", "n_crossing", "n_outside"],
            )

    found = docs.select("doc_id", "text").mapInArrow(count, f"doc_id {id_type}, {SCHEMA}")
    return found.fillna({"n_tokens": 0.0, "n_crossing": 0, "n_outside": 0.0})
