import random
import zlib
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from haulmart.llm import packing


@pytest.fixture(scope="module")
def library():
    made = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    made.encode_special_tokens = True
    return lambda text: made.encode(text or "", add_special_tokens=False).ids


@settings(deadline=None, max_examples=60)
@given(st.dictionaries(st.integers(1, 40), st.integers(1, 300)), st.just(40))
def test_patterns_hold_every_piece_once(histogram, size):
    patterns = packing.shortest_pack_first(histogram, size)
    held = Counter()
    for p in patterns:
        assert 0 < p.fill <= size and p.count > 0
        for length, times in p.parts:
            held[length] += p.count * times
    assert held == histogram and len(patterns) <= 2 * len(histogram) + 1
    places, used = packing.Places.of(patterns), Counter()
    for length, n in histogram.items():
        sequence, offset = places.find(np.full(n, length), np.arange(n))
        for s, o in zip(sequence.tolist(), offset.tolist()):
            used.update((s, o + k) for k in range(length))
    assert set(used.values()) <= {1}
    fills = Counter(s for s, _ in used)
    assert sorted(fills) == list(range(len(fills)))
    assert all(max(o for s, o in used if s == q) + 1 == n for q, n in fills.items())


def test_a_billion_pieces_are_as_quick():
    patterns = packing.shortest_pack_first({1: 10**9, 700: 10**9, 2048: 10**9})
    assert sum(p.count for p in patterns) >= 10**9 * (2048 + 701) // 2048 and len(patterns) <= 6


def test_ids_equal_the_library(library):
    rng = random.Random(3)
    letters = "aZ é́ß漢字кирИ١٢½'s'LL \t\n  ‍😀<|endoftext|>"
    texts = ["".join(rng.choice(letters) for _ in range(rng.randrange(40))) for _ in range(3000)]
    texts += ["".join(map(chr, range(a, a + 64))) for a in range(0, 0x3000, 64)]
    encode = packing.encoding(packing.ranks_path()).encode_to_numpy
    assert all(encode(t, disallowed_special=()).tolist() == library(t) for t in texts)


def checked(pieces, docs, library, size):
    """Every id of every document lies in one piece, and pieces fill sequences without gaps."""
    rows = pieces.collect()
    by_doc = {}
    for r in rows:
        by_doc.setdefault(r.doc_id, []).append(r)
    for doc_id, texts in docs.items():
        want = Counter(tuple(library(t)) + (1,) for t in texts)
        mine = sorted(by_doc.pop(doc_id), key=lambda r: (r.doc_tokens, r.start))
        if len(texts) == 1:
            ids = [x for r in mine for x in r.ids]
            assert Counter([tuple(ids)]) == want and [r.start for r in mine] == list(range(0, len(ids), size))
        assert sum(r.length for r in mine) == sum(map(len, want.elements()))
        assert all(len(r.ids) == r.length for r in mine)
    assert not by_doc
    places = Counter((r.sequence_id, r.offset + k) for r in rows for k in range(r.length))
    assert set(places.values()) <= {1}
    fills = Counter(s for s, _ in places)
    assert sorted(fills) == list(range(len(fills)))
    assert all((s, k) in places for s, n in fills.items() for k in range(n)) and max(fills.values(), default=0) <= size
    return rows, fills


def test_whole_documents_are_packed(docs_of, library):
    rng = random.Random(5)
    texts = [" ".join(rng.choice(["alpha", "beta", "x", "漢"]) for _ in range(rng.choice([1, 5, 60, 400]))) for _ in range(120)]
    pieces = packing.packed(docs_of(texts, partitions=5), size=128)
    rows, fills = checked(pieces, {i: [t] for i, t in enumerate(texts)}, library, 128)
    # Little padding: the sequences are few more than the ids need.
    assert len(fills) <= sum(r.length for r in rows) / 128 * 1.1 + 1
    made = {r.sequence_id: r for r in packing.sequences(pieces, 128).collect()}
    assert sorted(made) == sorted(fills)
    for r in rows:
        s = made[r.sequence_id]
        assert s.ids[r.offset : r.offset + r.length] == r.ids and s.n_tokens == len(s.ids) == fills[r.sequence_id]
        assert s.padded_to == (s.n_tokens if s.n_tokens & (s.n_tokens - 1) == 0 else 128)


def test_digests(docs_of, library):
    rows = packing.packed(docs_of(["one two", None])).select("doc_id", packing.crc32_of("ids").alias("c")).collect()
    plain = lambda t: zlib.crc32(np.array(library(t) + [1], "<u4").tobytes())
    assert {r.doc_id: r.c for r in rows} == {0: plain("one two"), 1: plain("")}


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_rows(docs_of, odd_rows, library, clashing):
    docs = {}
    for r in odd_rows:
        docs.setdefault(r[0], []).append(r[1])
    checked(packing.packed(docs_of(odd_rows, clashing)), docs, library, packing.SIZE)


def test_no_rows(docs_of):
    none = packing.packed(docs_of(["x"]).limit(0))
    assert none.count() == 0 and packing.sequences(none).count() == 0


def test_one_length_in_a_third_of_all_rows(docs_of, library):
    texts = ["same words here"] * 300 + [f"other {i} words" for i in range(60)]
    checked(packing.packed(docs_of(texts, partitions=7), size=16), {i: [t] for i, t in enumerate(texts)}, library, 16)
