import random

import numpy as np
import pytest

from haulmart.llm import leaks


def brute_distance(passage, text):
    """Least edits of the passage anywhere in the text, over the whole table."""
    row = [0] * (len(text) + 1)
    for i, p in enumerate(passage, 1):
        now = [i]
        for j, c in enumerate(text, 1):
            now.append(min(row[j - 1] + (p != c), row[j] + 1, now[j - 1] + 1))
        row = now
    return min(row)


def prose(rng, n):
    return " ".join("".join(rng.choice("aeiourstlnmdk") for _ in range(rng.randrange(2, 8))) for _ in range(n))


def edited(rng, text, n):
    letters = list(text)
    for _ in range(n):
        at = rng.randrange(len(letters))
        kind = rng.randrange(3)
        if kind == 0:
            letters[at] = rng.choice("xyz")
        elif kind == 1:
            letters.insert(at, rng.choice("xyz"))
        else:
            del letters[at]
    return "".join(letters)


@pytest.fixture(scope="module")
def case():
    rng = random.Random(3)
    items = [(i, prose(rng, rng.randrange(9, 40))) for i in range(12)] + [(90, "tiny"), (91, None), (92, "")]
    texts = [None, "", "short", prose(rng, 300)]
    for i in range(12):
        m = len(leaks.letters(items[i][1]))
        for n in (0, 1, m // 20, m // 10, m // 10 + 3, m // 4):
            texts.append(f"{prose(rng, 30)} {edited(rng, items[i][1], n)} {prose(rng, 30)}")
    texts.append(items[3][1].upper().replace(" ", "!!\n"))
    texts.append(items[4][1] + items[4][1])
    texts.append(items[5][1][: len(items[5][1]) // 2])
    return items, texts


def wanted(items, texts):
    out = {}
    for d, text in enumerate(texts):
        for i, passage in items:
            p = leaks.letters(passage)
            if len(p) >= leaks.Q:
                edits = brute_distance(p, leaks.letters(text))
                if edits <= leaks.edit_budget(len(p)):
                    out[d, i] = edits
    return out


@pytest.mark.parametrize("block", [60, 1_000_000])
def test_equals_a_search_of_everything(spark, docs_of, case, block):
    items, texts = case
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    want = wanted(items, texts)
    got = {(r.doc_id, r.item_id): r.edits for r in leaks.matches(docs_of(texts), benchmark, block).collect()}
    assert len(want) > 40 and got == want
    clean = leaks.without_leaks(docs_of(texts), benchmark, block)
    assert {r.doc_id for r in clean.collect()} == set(range(len(texts))) - {d for d, _ in want}


def test_banded_alignment_equals_the_whole_table():
    rng = random.Random(8)
    for _ in range(60):
        passage = leaks.letters(prose(rng, 12))
        k = leaks.edit_budget(len(passage))
        width = 2 * (k + 1) + 2 * k
        region = edited(rng, passage.decode(), rng.randrange(2 * k)).encode()
        # As in a search, the region begins k letters before the band's first diagonal.
        region = (b"q" * (k + rng.randrange(k + 1)) + region).ljust(len(passage) + width, b"q")[: len(passage) + width]
        got = int(leaks.aligned(passage, np.frombuffer(region, np.uint8)[None, :], k)[0])
        want = brute_distance(passage, region)
        assert got == want if want <= k else got > k


def test_odd_rows_and_empty_tables(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows, clashing=True)
    benchmark = spark.createDataFrame(
        [(1, "the quick brown fox jumps over the lazy dog"), (None, "same text in two rows"), (1, None)],
        "item_id long, text string",
    )
    got = [(r.doc_id, r.item_id) for r in leaks.matches(docs, benchmark).collect()]
    assert sorted(got, key=str) == [(5, 1), (8, None), (8, None), (9, None)]
    clean = leaks.without_leaks(docs, benchmark)
    assert clean.columns == docs.columns and clean.count() == len(odd_rows) - 4
    assert leaks.matches(docs, benchmark.limit(0)).count() == 0
    assert leaks.without_leaks(docs, benchmark.limit(0)).count() == len(odd_rows)
    assert leaks.matches(docs.limit(0), benchmark).count() == 0
