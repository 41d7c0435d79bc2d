"""Toxicity by a string-kernel support vector machine with Nyström landmarks.

The kernel compares two words by the three-letter subsequences they share. A
subsequence may have gaps, up to a span of five letters, and counts less for
each letter of gap, so an insult with letters put in, left out or changed still
shares most of its weight. Words are first freed of signs inside them, and
letters spelled apart are put together.

A sentence is as toxic as its worst word, so training is of the
multiple-instance kind: each toxic text of the sample lends its most telling
word, every word of a harmless text is harmless, and the choice is repeated
with the machine that it gave. A text's score weighs its worst word, the share
of its words that the machine takes for toxic, and its length; the weights are
fitted on sampled texts that the machine has not seen. In the feature space of the
landmarks the machine is linear, and since each landmark's kernel is a sum over
subsequences, all of it folds into one weight for each subsequence: a table of
constant size, whatever the corpus.
"""

from __future__ import annotations

import re
from dataclasses import dataclass

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DoubleType, StringType

from haulmart.llm.shared import keep

# (gap to the second letter, to the third): spans of three, four and five.
PATTERNS = ((1, 2), (1, 3), (2, 3), (1, 4), (2, 4), (3, 4))
DECAY = 0.5
LETTERS = 64
# A longer word is compared in overlapping pieces of this length.
PIECE = 32
# Bounds of the sample: texts of each class, words of each toxic text, harmless words.
TOXIC_TEXTS = 4_000
OTHER_TEXTS = 8_000
TELLING_WORDS = 40
HARMLESS_WORDS = 60_000
LANDMARKS = 320
ROUNDS = 4
REGULAR = 1e-4
THRESHOLD = 0.3
# Words whose features are made or summed at a time.
BLOCK = 8192
# Scored words that a worker remembers between batches.
REMEMBERED = 800_000

_APART = re.compile(r"(?<!\S)(?:\w\s+){2,}\w(?!\S)")
_SIGNS = re.compile(r"[\W_]+")


def words(text: str | None) -> list[str]:
    """Lower-case words by white space, and letters spelled apart as one word more."""
    low = (text or "").lower()
    return low.split() + [re.sub(r"\s+", "", m) for m in _APART.findall(low)]


def bare(word: str) -> str:
    return _SIGNS.sub("", word)


def pieces(word: str) -> list[str]:
    if len(word) <= PIECE:
        return [word]
    return [word[i : i + PIECE] for i in range(0, len(word) - PIECE // 2, PIECE // 2)]


def _letter_codes() -> np.ndarray:
    """A code for each Latin-1 character: a-z, digits, and the others by their number."""
    codes = np.array([30 + c % (LETTERS - 30) for c in range(256)], np.int64)
    codes[ord("a") : ord("z") + 1] = np.arange(1, 27)
    codes[ord("0") : ord("9") + 1] = 27
    return codes


_CODES = _letter_codes()
_BEGIN, _END = 28, 29


def subsequences(row: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """(feature numbers, weights) of words of at most ``PIECE`` letters, a row each.

    Weights of a row have length one, which makes the kernel of two words their
    cosine. Places past the end of a word have weight zero.
    """
    width = max((len(w) for w in row), default=0) + 2
    codes = np.zeros((len(row), width), np.int64)
    for i, word in enumerate(row):
        points = np.array([ord(c) for c in word], np.int64)
        own = np.where(points < 256, _CODES[np.minimum(points, 255)], 30 + points % (LETTERS - 30))
        codes[i, 0] = _BEGIN
        codes[i, 1 : 1 + len(word)] = own
        codes[i, 1 + len(word)] = _END
    features, weights = [], []
    for second, third in PATTERNS:
        n = width - third
        if n <= 0:
            continue
        last = codes[:, third : third + n]
        features.append((codes[:, :n] * LETTERS + codes[:, second : second + n]) * LETTERS + last)
        weights.append(np.where(last > 0, np.float32(DECAY ** (third - 2)), np.float32(0)))
    if not features:
        return np.zeros((len(row), 1), np.int64), np.zeros((len(row), 1), np.float32)
    feature, weight = np.concatenate(features, 1), np.concatenate(weights, 1)
    length = np.sqrt((weight**2).sum(1, keepdims=True))
    return feature, weight / np.maximum(length, 1e-9)


def kernel(row: list[str], landmarks: list[str]) -> np.ndarray:
    """Kernel values of words (rows) with landmarks (columns)."""
    feature, weight = subsequences(landmarks)
    known = np.unique(feature[weight > 0])
    table = np.zeros((len(known) + 1, len(landmarks)), np.float32)
    at = np.where(weight > 0, np.searchsorted(known, feature), len(known))
    for j in range(feature.shape[1]):
        np.add.at(table, (at[:, j], np.arange(len(landmarks))), weight[:, j])
    table[-1] = 0
    out = np.zeros((len(row), len(landmarks)), np.float32)
    for a in range(0, len(row), 2000):
        feature, weight = subsequences(row[a : a + 2000])
        at = np.searchsorted(known, feature)
        at[at == len(known)] = 0
        at = np.where(known[at] == feature, at, len(known)) if len(known) else np.zeros_like(at)
        for j in range(feature.shape[1]):
            out[a : a + 2000] += table[at[:, j]] * weight[:, j : j + 1]
    return out


def features(row: list[str], landmarks: list[str], root: np.ndarray) -> np.ndarray:
    """Words in the feature space of the landmarks, made block by block."""
    blocks = [
        kernel(row[a : a + BLOCK], landmarks) @ root.astype(np.float32)
        for a in range(0, len(row), BLOCK)
    ]
    return np.concatenate(blocks) if blocks else np.empty((0, root.shape[1]), np.float32)


def _machine(x: np.ndarray, y: np.ndarray, cost: np.ndarray) -> np.ndarray:
    """Weights of a linear machine with squared hinge loss, the last for a constant, by Newton steps.

    Sums run over blocks of rows, so beside ``x`` only a block is held.
    """
    w = np.zeros(x.shape[1] + 1)
    for _ in range(30):
        gradient, curve = REGULAR * w, REGULAR * np.eye(len(w))
        for a in range(0, len(x), BLOCK):
            part = np.c_[x[a : a + BLOCK].astype(float), np.ones(len(x[a : a + BLOCK]))]
            sign, weight = y[a : a + BLOCK], cost[a : a + BLOCK]
            slack = 1 - sign * (part @ w)
            on = slack > 0
            part, pull = part[on], weight[on]
            gradient = gradient - part.T @ (pull * sign[on] * slack[on])
            curve = curve + (part * pull[:, None]).T @ part
        step = np.linalg.solve(curve, gradient)
        w = w - step
        if np.abs(step).max() < 1e-6:
            break
    return w


@dataclass(frozen=True)
class Model:
    """A weight for each subsequence, a constant, and how a worst word becomes a score."""

    weights: np.ndarray
    constant: float
    scale: tuple[float, float, float, float]

    def of_words(self, row: list[str]) -> np.ndarray:
        """The machine's value of bare words; of long words the largest of their pieces'."""
        cut = [pieces(w) for w in row]
        flat = [p for ps in cut for p in ps]
        values = np.empty(len(flat))
        # Alike in length, the rows of a block are filled well.
        order = sorted(range(len(flat)), key=lambda i: len(flat[i]))
        for a in range(0, len(order), 4000):
            own = order[a : a + 4000]
            feature, weight = subsequences([flat[i] for i in own])
            values[own] = (self.weights[feature] * weight).sum(1) + self.constant
        starts = np.cumsum([0, *map(len, cut)])[:-1]
        return np.maximum.reduceat(values, starts) if len(values) else values

    def scores(self, worst: np.ndarray, toxic_words: np.ndarray, n_words: np.ndarray) -> np.ndarray:
        value = _measures(worst, toxic_words, n_words) @ np.array(self.scale)
        return 1 / (1 + np.exp(-np.clip(value, -50, 50)))


NO_WORD = -2.0


def _measures(worst: np.ndarray, toxic_words: np.ndarray, n_words: np.ndarray) -> np.ndarray:
    """What a text is judged by: worst word, toxic words in a hundred, length, and one."""
    share = np.log1p(100 * toxic_words / np.maximum(n_words, 1))
    return np.c_[np.clip(worst, NO_WORD, 2), share, np.log1p(n_words), np.ones(len(worst))]


def toxic_part(values: np.ndarray) -> np.ndarray:
    """How far the machine takes a word for toxic: its value, from 0 to 1."""
    return np.clip(values, 0, 1)


def _fold_in(landmarks: list[str], root: np.ndarray, w: np.ndarray) -> np.ndarray:
    """The weight of each subsequence: what the landmarks that hold it bring to the value."""
    alpha = root @ w[:-1]
    out = np.zeros(LETTERS**3, np.float64)
    feature, weight = subsequences(landmarks)
    np.add.at(out, feature.ravel(), (weight * alpha[:, None]).ravel())
    return out.astype(np.float32)


def _calibrated(x: np.ndarray, toxic: np.ndarray) -> tuple[float, ...]:
    """Logistic weights of the measures."""
    w = np.zeros(x.shape[1])
    pull = 1e-2 * np.array([1, 1, 1, 0])
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(x @ w, -30, 30)))
        step = np.linalg.solve(
            (x * (p * (1 - p))[:, None]).T @ x + np.diag(pull + 1e-6), x.T @ (p - toxic) + pull * w
        )
        w = w - step
        if np.abs(step).max() < 1e-8:
            break
    return tuple(float(v) for v in w)


def train(sample: DataFrame) -> Model:
    """A model from rows (doc, toxic, word, times): the bare words of sampled texts.

    A quarter of the texts is left for calibration. Only bounded numbers of
    words come to the driver. Without both classes every score is the share of
    toxic texts.
    """
    fold = F.pmod(F.xxhash64("doc", F.lit(1)), F.lit(4)) == 0
    rows = sample.withColumn("calibrates", fold)
    texts = rows.groupBy("doc", "toxic", "calibrates").agg(F.sum("times").alias("n_words"))
    sizes = {r["toxic"]: r["n"] for r in texts.filter(~F.col("calibrates")).groupBy("toxic").agg(F.count(F.lit(1)).alias("n")).collect()}
    n_toxic, n_other = sizes.get(1, 0), sizes.get(0, 0)
    if not n_toxic or not n_other:
        share = (n_toxic + 0.5) / (n_toxic + n_other + 1)
        return Model(np.zeros(LETTERS**3, np.float32), 0.0, (0.0, 0.0, 0.0, float(np.log(share / (1 - share)))))

    fit = rows.filter(~F.col("calibrates") & F.col("word").isNotNull())
    seen = fit.groupBy("word").agg(F.sum("toxic").alias("toxic_texts"), F.sum(1 - F.col("toxic")).alias("other_texts"))
    telling = F.log((F.col("toxic_texts") + 0.1) / n_toxic) - F.log((F.col("other_texts") + 0.5) / n_other)
    seen = keep(seen.withColumn("telling", telling), "words")
    of_toxic = fit.filter("toxic = 1").join(seen, "word")
    best = of_toxic.groupBy("doc").agg(
        F.slice(F.sort_array(F.collect_list(F.struct("telling", "word")), asc=False), 1, TELLING_WORDS).alias("w")
    ).orderBy("doc").limit(TOXIC_TEXTS)
    bags = [[x["word"] for x in r["w"]] for r in best.collect()]
    harmless = [
        r["word"] for r in seen.filter("other_texts > 0")
        .orderBy(F.col("toxic_texts").desc(), F.xxhash64("word"), "word").limit(HARMLESS_WORDS).collect()
    ]
    harmless = [p for w in harmless for p in pieces(w)]
    chosen = [bag[0] for bag in bags if bag]
    counts = pd.Series(chosen).value_counts()
    leading = sorted(counts.index, key=lambda w: (-counts[w], w))[: LANDMARKS * 2 // 3]
    step = max(1, len(harmless) // (LANDMARKS - len(leading)))
    landmarks = list(dict.fromkeys([pieces(w)[0] for w in leading] + harmless[::step][: LANDMARKS - len(leading)]))
    values, vectors = np.linalg.eigh(kernel(landmarks, landmarks).astype(np.float64))
    held = values > 1e-4
    root = vectors[:, held] / np.sqrt(values[held])

    pool = sorted({p for bag in bags for w in bag for p in pieces(w)})
    at = {p: i for i, p in enumerate(pool)}
    inside = [[at[p] for w in bag for p in pieces(w)] for bag in bags if bag]
    other_x = features(harmless, landmarks, root)
    witness = [own[0] for own in inside]
    for _ in range(ROUNDS):
        # Texts that lend one word count as often as there are texts.
        lent, times = np.unique(witness, return_counts=True)
        x = np.concatenate([features([pool[i] for i in lent], landmarks, root), other_x])
        y = np.r_[np.ones(len(lent)), -np.ones(len(other_x))]
        cost = np.r_[times / len(witness), np.full(len(other_x), 1 / len(other_x))]
        w = _machine(x, y, cost)
        model = Model(_fold_in(landmarks, root, w), float(w[-1]), (1.0, 0.0, 0.0, 0.0))
        value = model.of_words(pool)
        witness = [own[int(np.argmax(value[own]))] for own in inside]

    def value_of(row: pd.Series) -> pd.Series:
        return pd.Series(model.of_words(row.tolist()))

    valued = rows.filter(F.col("calibrates") & F.col("word").isNotNull()).withColumn(
        "value", F.pandas_udf(value_of, DoubleType())("word")
    )
    part = F.greatest(F.lit(0.0), F.least(F.lit(1.0), "value"))  # toxic_part
    of_text = valued.groupBy("doc").agg(
        F.max("value").alias("worst"), F.sum(part * F.col("times")).alias("toxic_words")
    )
    held_back = (
        texts.filter("calibrates").join(of_text, "doc", "left")
        .select(
            "toxic", F.coalesce("worst", F.lit(NO_WORD)).alias("worst"),
            F.coalesce("toxic_words", F.lit(0.0)).alias("toxic_words"), "n_words",
        ).toPandas()
    )
    if held_back["toxic"].nunique() < 2:
        return model
    x = _measures(*(held_back[c].to_numpy(float) for c in ("worst", "toxic_words", "n_words")))
    scale = _calibrated(x, held_back["toxic"].to_numpy(float))
    return Model(model.weights, model.constant, scale)


def sampled_words(docs: DataFrame, labels: DataFrame, toxic_texts: int, other_texts: int) -> DataFrame:
    """(doc, toxic, word, times) of a bounded sample of labelled texts, first by a hash of doc_id.

    Rows without a label, an id or a text are not drawn; of repeated labels of
    an id the highest holds. A text without words has one row with word null and
    ``times`` 0.
    """
    labelled = labels.filter("toxic is not null and doc_id is not null").groupBy("doc_id").agg(
        F.max(F.col("toxic").cast("int")).alias("toxic")
    )
    drawn = None
    for label, bound in ((1, toxic_texts), (0, other_texts)):
        own = labelled.filter(F.col("toxic") == label).orderBy(F.xxhash64("doc_id"), "doc_id").limit(bound)
        drawn = own if drawn is None else drawn.unionByName(own)
    drawn = keep(drawn.select(F.col("doc_id").alias("doc"), "toxic"), "sample")

    def bared(texts: pd.Series) -> pd.Series:
        return pd.Series([[b for w in words(t) if (b := bare(w))] for t in texts], dtype=object)

    # Bounded by the number of texts drawn.
    met = docs.select("doc_id", "text").join(F.broadcast(drawn), F.col("doc_id") == F.col("doc")).filter("text is not null")
    each = F.explode_outer(F.pandas_udf(bared, ArrayType(StringType()))("text"))
    counted = met.select("doc", "toxic", each.alias("word")).groupBy("doc", "toxic", "word")
    return keep(counted.agg(F.count("word").alias("times")), "sample_words")


_remembered: dict[int, dict[str, float]] = {}


def scored(docs: DataFrame, model: Model) -> DataFrame:
    """All columns of ``docs`` with ``score``; that name is replaced.

    Whole texts are scored, from nothing but the text. Null and empty texts
    have no word and get the score of a text with none.
    """
    shipped = docs.sparkSession.sparkContext.broadcast(model)
    number = shipped._jbroadcast.id()

    def score(texts: pd.Series) -> pd.Series:
        own, known = shipped.value, _remembered.setdefault(number, {})
        cut = [words(t) for t in texts]
        new = list({w for row in cut for w in row if w not in known})
        bared = [bare(w) for w in new]
        values = own.of_words(bared)
        values[[not b for b in bared]] = np.nan
        known.update(zip(new, values.tolist()))
        measures = []
        for row in cut:
            values = np.fromiter(map(known.__getitem__, row), float, len(row))
            values = values[~np.isnan(values)]
            measures.append((values.max(initial=NO_WORD), toxic_part(values).sum(), len(values)))
        if len(known) > REMEMBERED:
            known.clear()
        return pd.Series(own.scores(*np.array(measures, float).reshape(-1, 3).T))

    return docs.withColumn("score", F.pandas_udf(score, DoubleType())("text"))


def held_out() -> Column:
    """Rows that training never sees: crc32 of the id as text leaves 2 of 4."""
    return F.coalesce(F.crc32(F.col("doc_id").cast("string").cast("binary")) % 4 == 2, F.lit(False))


def classified(
    docs: DataFrame, labels: DataFrame,
    toxic_texts: int = TOXIC_TEXTS, other_texts: int = OTHER_TEXTS,
) -> DataFrame:
    """doc_id, held_out, score and predicted of every row of ``docs``."""
    model = train(sampled_words(docs, labels.filter(~held_out()), toxic_texts, other_texts))
    out = scored(docs.select("doc_id", "text"), model)
    return out.select(
        "doc_id", held_out().alias("held_out"), "score",
        (F.col("score") >= THRESHOLD).cast("int").alias("predicted"),
    )
