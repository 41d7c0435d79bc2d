import random
import zlib

import numpy as np
import pytest

from haulmart.llm import toxicity


def brute_kernel(a, b):
    """Shared gapped subsequences of two words, by listing them."""

    def features(word):
        row = ["^", *word, "$"]
        out = []
        for i in range(len(row)):
            for j in range(i + 1, len(row)):
                for k in range(j + 1, len(row)):
                    if k - i <= 4:
                        out.append(((row[i], row[j], row[k]), toxicity.DECAY ** (k - i - 2)))
        return out

    fa, fb = features(a), features(b)
    norm = np.sqrt(sum(w * w for _, w in fa)) * np.sqrt(sum(w * w for _, w in fb))
    return sum(v * w for x, v in fa for y, w in fb if x == y) / norm if norm else 0.0


def test_kernel_equals_a_plain_one():
    row = ["idiot", "idxiot", "idiott", "a", "banana", "moron", "onmoro", "q" * 32]
    got = toxicity.kernel(row, ["idiot", "banana", "moron", "a"])
    want = [[brute_kernel(a, b) for b in ("idiot", "banana", "moron", "a")] for a in row]
    assert np.allclose(got, want, atol=1e-5)


def test_folded_weights_equal_the_machine():
    landmarks = ["idiot", "banana", "tree", "water"]
    values, vectors = np.linalg.eigh(toxicity.kernel(landmarks, landmarks).astype(float))
    root, w = vectors / np.sqrt(values), np.array([0.3, -1.0, 2.0, 0.5, -0.25])
    model = toxicity.Model(toxicity._fold_in(landmarks, root, w), w[-1], (1, 0, 0, 0))
    row = ["idiot", "wxater", "q", "", "long" * 30]
    plain = [max((toxicity.kernel([p], landmarks) @ root @ w[:-1] + w[-1])[0] for p in toxicity.pieces(x)) for x in row]
    assert np.allclose(model.of_words(row), plain, atol=1e-5)


@pytest.fixture(scope="module")
def corpus():
    rng = random.Random(2)
    syllables = [a + b for a in "bdfgklmnprst" for b in "aeiou"]
    word = lambda: "".join(rng.choice(syllables) for _ in range(rng.randrange(1, 4)))
    insults = ["idiot", "moronic", "wretch", "scumbag", "halfwit"]
    rows, labels = [], []
    for i in range(700):
        text = [word() for _ in range(rng.randrange(20, 120))]
        toxic = i % 4 == 0
        if toxic:
            for _ in range(3):
                text.insert(rng.randrange(len(text)), rng.choice(insults))
        rows.append((i, " ".join(text), "en", "s"))
        labels.append((i, int(toxic)))
    clean = [(1000 + i, " ".join(word() for _ in range(50)), "en", "s") for i in range(60)]
    odd = [(2000, "x " + " ".join(word() for _ in range(20)) + " i-d-i-o-t id1iot idiiot", "en", "s"),
           (2001, " ".join(word() for _ in range(20)) + " h a l f w i t halfw1it, HALFWIT!", "en", "s")]
    return rows, labels, clean, odd


def test_held_out_rows_are_told_apart(spark, docs_of, corpus):
    rows, labels, clean, odd = corpus
    docs = docs_of(rows + clean + odd)
    frame = spark.createDataFrame(labels, "doc_id long, toxic int")
    got = {r.doc_id: r for r in toxicity.classified(docs, frame).collect()}
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.3) for r in got.values())
    held = [(got[i].predicted, toxic) for i, toxic in labels if got[i].held_out]
    assert len(held) > 100 and sum(p == t for p, t in held) >= 0.97 * len(held)
    assert sum(got[r[0]].predicted for r in clean) <= 2
    assert all(got[r[0]].predicted == 1 for r in odd)


def test_labels_of_held_out_rows_change_nothing(spark, docs_of, corpus):
    rows, labels, _, _ = corpus
    docs = docs_of(rows)
    turned = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    one, two = (
        {r.doc_id: r.score for r in toxicity.classified(docs, spark.createDataFrame(x, "doc_id long, toxic int")).collect()}
        for x in (labels, turned)
    )
    assert one == two


def test_odd_rows(spark, docs_of, odd_rows):
    docs = docs_of(odd_rows, clashing=True)
    labels = [(1, 1, "a"), (4, 0, "a"), (5, 0, None), (5, 1, "a"), (7, None, "a"), (None, 1, "a"), (99, 1, "a"), (9, 0, "a"), (8, 1, "b")]
    frame = spark.createDataFrame(labels, "doc_id long, toxic int, doc string")
    got = toxicity.classified(docs, frame).collect()
    assert len(got) == len(odd_rows) and all(0 <= r.score <= 1 for r in got)
    for few in (frame.limit(0), frame.filter("toxic = 1")):
        assert all(0 <= r.score <= 1 for r in toxicity.classified(docs, few).collect())
    assert toxicity.classified(docs.limit(0), frame).count() == 0
