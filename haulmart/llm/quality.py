"""Quality rules whose limits follow each language and source.

Every document is measured in its own row. The measures of each (language,
source) go into quantile sketches: histograms over fixed bins that grow with
the value (exact to 63, then 32 bins per doubling, so within 1/32). Sketches
are merged by adding counts, in map tasks, across sources and across languages,
and come out the same in any order. Limits are fences read off the sketches,
and documents meet them in a join.

A limit is a tail quantile of the sketch, and beyond it a share of its distance
from the median. A sketch in which junk is common has a wide limit of its own,
and one of few documents may have a narrow one. So every limit is held between
half and one and a half of the median of the language's sources, and those
medians likewise by that of all sources; each source has one vote whatever its
size.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmart.llm.shared import keep, unpack, whole_row

WHITE = " \t\n\x0b\x0c\r"
SYMBOLS = "#*$%&|<>"

# Fixed values of the base rule.
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50


@dataclass(frozen=True)
class Fence:
    """A limit at the ``tail`` percentile and as far beyond as 3/2 of its distance from the median."""

    measure: str
    tail: int

    @property
    def below(self) -> bool:
        return self.tail < 50


# Measures are whole numbers: hundredths of a character, or parts of a thousand.
FENCES = (
    Fence("word_length", 95),
    Fence("word_length", 5),
    Fence("symbol_share", 95),
    Fence("line_share", 99),
    Fence("repeat_share", 99),
)
MEASURES = tuple(dict.fromkeys(f.measure for f in FENCES))
# A sketch of fewer documents is replaced by that of the language, then of all.
MIN_SKETCH = 200
# A source of fewer documents has no vote in the median.
MIN_VOTE = 20
# Parts that the rows of one (language, source) are dealt to in the join.
SALTS = 32


def _repeated_words(of: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words inside a 3-word window that occurs twice or more.

    Windows are compared by 64-bit hash. Equal ones meet by sorting the array
    of one document; no document's windows leave its row.
    """
    n = F.greatest(F.col("n_words") - 2, F.lit(0)).cast("int")
    hashes = F.transform("words", lambda w: F.xxhash64(w))
    pairs = F.zip_with(
        F.slice("hashes", 1, n), F.slice("hashes", 2, n), lambda a, b: F.xxhash64(a, b)
    )
    windows = F.zip_with(pairs, F.slice("hashes", 3, n), lambda ab, c: F.xxhash64(ab, c))
    placed = F.transform("windows", lambda h, i: F.struct(h.alias("h"), i.alias("p")))
    some = F.size(F.array_distinct("windows")) < F.size("windows")
    last = F.size("placed")
    same_as_next = F.zip_with(
        F.col("placed.h"), F.slice(F.col("placed.h"), 2, last), lambda a, b: a.eqNullSafe(b)
    )
    repeated = F.zip_with(
        F.col("same"),
        F.slice(F.concat(F.array(F.lit(False)), F.col("same")), 1, last),
        lambda a, b: a | b,
    )
    places = F.filter(
        F.zip_with(F.col("placed.p"), F.col("repeated"), lambda p, r: F.when(r, p)),
        lambda p: p.isNotNull(),
    )
    # A window covers three words, fewer where the next one starts inside it.
    covered = F.aggregate(
        F.zip_with(
            F.col("places"),
            F.slice("places", 2, F.size("places")),
            lambda a, b: F.least(F.lit(3), b - a),
        ),
        F.lit(0),
        lambda total, x: total + x,
    )
    return (
        of.withColumn("hashes", hashes)
        .withColumn("windows", windows)
        .withColumn("placed", F.when(some, F.sort_array(placed)))
        .withColumn("same", same_as_next)
        .withColumn("repeated", repeated)
        .withColumn("places", F.sort_array(places))
        .withColumn("n_repeat_words", F.coalesce(covered, F.lit(0)).cast("long"))
        .drop("hashes", "windows", "placed", "same", "repeated", "places")
    )


def measured(docs: DataFrame, carried: list[Column]) -> DataFrame:
    """The base counts of every whole text, beside the ``carried`` columns.

    A null text has no words and no lines. Long texts are worked on in one row.
    """
    text = F.coalesce(F.col("text"), F.lit(""))
    trimmed = F.btrim(text, F.lit(WHITE))
    rows = docs.select(*carried, text.alias("body"), trimmed.alias("trimmed"))
    rows = rows.withColumn(
        "words",
        F.when(F.col("trimmed") == "", F.array().cast("array<string>")).otherwise(
            F.split("trimmed", r"[\x20\x09-\x0D]+", -1)
        ),
    ).withColumn(
        # Lines are compared as they stand, white space at their ends included.
        "lines",
        F.filter(F.split("body", "\n", -1), lambda x: F.btrim(x, F.lit(WHITE)) != ""),
    )
    length = F.length("body")
    rows = rows.withColumns({
        "n_words": F.size("words").cast("long"),
        "word_chars": F.length(F.translate("body", WHITE, "")).cast("long"),
        "n_symbols": (length - F.length(F.translate("body", SYMBOLS, ""))).cast("long"),
        "n_lines": F.size("lines").cast("long"),
        "n_dup_lines": (F.size("lines") - F.size(F.array_distinct("lines"))).cast("long"),
    })
    rows = _repeated_words(rows).drop("body", "trimmed", "words", "lines")
    return rows.withColumn(
        "base_failed",
        (F.col("n_words") < MIN_WORDS)
        | (100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")),
    ).withColumns({
        "word_length": F.expr("word_chars * 100 div greatest(n_words, 1)"),
        "symbol_share": F.expr("n_symbols * 1000 div greatest(n_words, 1)"),
        "line_share": F.expr("n_dup_lines * 1000 div greatest(n_lines, 1)"),
        "repeat_share": F.expr("n_repeat_words * 1000 div greatest(n_words, 1)"),
    })


def bin_of(value: Column) -> Column:
    """The sketch bin of a whole number of at least 0."""
    shift = F.greatest(F.length(F.bin(value)) - 6, F.lit(0))
    return F.when(value < 64, value).otherwise(
        shift.cast("long") * 32 + F.floor(value / F.pow(F.lit(2.0), shift)).cast("long")
    )


def value_of(bin_: Column, least: bool = False) -> Column:
    """The largest number of a bin, or its least."""
    shift = F.floor(bin_ / 32) - 1
    first = bin_ - shift * 32
    wide = F.pow(F.lit(2.0), shift)
    end = first * wide if least else (first + 1) * wide - 1
    return F.when(bin_ < 64, bin_).otherwise(end.cast("long"))


def sketches(rows: DataFrame) -> DataFrame:
    """Counts by (lang, source, measure, bin) of the documents that pass the base rule."""
    each = F.explode(
        F.array(*[
            F.struct(F.lit(m).alias("measure"), bin_of(F.col(m)).alias("bin")) for m in MEASURES
        ])
    )
    return (
        rows.filter(~F.col("base_failed"))
        .select("lang", "source", each.alias("x"))
        .groupBy("lang", "source", "x.measure", "x.bin")
        .agg(F.count(F.lit(1)).alias("n"))
    )


def fences(sketch: DataFrame) -> DataFrame:
    """One row per (level, lang, source) with a limit for each fence and ``seen``.

    Level 0 is a source of a language, 1 a language, 2 everything. A window
    sees the bins of one sketch, of which there are a few hundred at most.
    """
    levels = [
        sketch.select(F.lit(0).alias("level"), "lang", "source", "measure", "bin", "n"),
        sketch.select(
            F.lit(1).alias("level"), "lang", F.lit(None).cast("string").alias("source"),
            "measure", "bin", "n",
        ),
        sketch.select(
            F.lit(2).alias("level"), F.lit(None).cast("string").alias("lang"),
            F.lit(None).cast("string").alias("source"), "measure", "bin", "n",
        ),
    ]
    key = ["level", "lang", "source", "measure"]
    merged = levels[0].unionByName(levels[1]).unionByName(levels[2])
    merged = merged.groupBy(*key, "bin").agg(F.sum("n").alias("n"))
    whole = Window.partitionBy(*key)
    running = whole.orderBy("bin").rowsBetween(Window.unboundedPreceding, 0)
    ranked = merged.withColumns({
        "upto": F.sum("n").over(running), "total": F.sum("n").over(whole),
    })
    def at(q: int) -> Column:
        found = F.min(F.when(100 * F.col("upto") >= q * F.col("total"), F.col("bin")))
        return value_of(found, least=q < 50)

    tails = sorted({f.tail for f in FENCES} | {50})
    quantiles = ranked.groupBy(*key).agg(*[at(q).alias(f"q{q}") for q in tails], F.max("total").alias("seen"))

    def limit(f: Fence) -> Column:
        tail = F.col(f"q{f.tail}")
        # Halves are cut off; no measure is below zero.
        return F.floor((5 * tail - 3 * F.col("q50")) / 2)

    limits = {
        f"limit_{i}": F.max(F.when(F.col("measure") == f.measure, limit(f))) for i, f in enumerate(FENCES)
    }
    return quantiles.groupBy("level", "lang", "source").agg(
        F.max("seen").alias("seen"), *[v.alias(k) for k, v in limits.items()]
    )


def _between(limit: Column, middle: Column) -> Column:
    """``limit`` held from half to one and a half of ``middle``; as it is without one."""
    low, high = F.floor(middle / 2), F.floor(3 * middle / 2)
    return F.coalesce(F.greatest(F.least(limit, high), low), limit)


def held(table: DataFrame) -> DataFrame:
    """``table`` of limits, each held by the median source of its language.

    Of two middle sources the wider counts. The median of a language is held
    by that of all sources, which also holds the limits of everything.
    """
    def middle(i: int, f: Fence) -> Column:
        limit = F.col(f"limit_{i}")
        if f.below:
            return F.percentile_approx(limit, 0.5, 10_000).alias(f"middle_{i}")
        return (-F.percentile_approx(-limit, 0.5, 10_000)).alias(f"middle_{i}")

    votes = table.filter((F.col("level") == 0) & (F.col("seen") >= MIN_VOTE))
    middles = [middle(i, f) for i, f in enumerate(FENCES)]
    by_language = votes.groupBy(F.col("lang").alias("of"), F.lit(True).alias("voted")).agg(*middles)
    # A row per language, and one row of all.
    of_all = votes.agg(*[m.alias(f"all_{i}") for i, m in enumerate(middles)])
    met = table.join(
        F.broadcast(by_language),
        F.col("lang").eqNullSafe(F.col("of")) & (F.col("level") < 2), "left",
    ).join(F.broadcast(of_all))
    limits = {}
    for i in range(len(FENCES)):
        whole = F.col(f"all_{i}")
        language = F.when(F.col("voted"), _between(F.col(f"middle_{i}"), whole)).otherwise(whole)
        limits[f"limit_{i}"] = _between(F.col(f"limit_{i}"), language)
    return met.withColumns(limits).select(*table.columns)


def judge(rows: DataFrame) -> DataFrame:
    """Adds ``kept`` to measured rows.

    The limits of a (language, source) are those of its own sketch where that
    saw ``MIN_SKETCH`` documents, else of its language, else of all. Null
    languages and sources are groups like any other. The limits are written
    first: Spark then knows how few they are, and no row is shuffled to meet
    them while they fit a broadcast. Beyond that, the rows of a group are dealt
    to ``SALTS`` parts, so a source with a third of all rows is not one task's work.
    """
    table = keep(held(keep(fences(sketches(rows)), "sketched")), "fences")
    names = [f"limit_{i}" for i in range(len(FENCES))]

    def at(level: int) -> DataFrame:
        return table.filter(F.col("level") == level).select(
            F.col("lang").alias(f"lang_{level}"), F.col("source").alias(f"source_{level}"),
            F.struct("seen", *names).alias(f"at_{level}"),
        )

    own, language = at(0), at(1)
    # One row: the sketch of everything.
    overall = table.filter(F.col("level") == 2).select("seen", *names).first()
    of_all = F.struct(*[
        F.lit(overall[c] if overall else None).cast(table.schema[c].dataType).alias(c)
        for c in ("seen", *names)
    ])
    enough = lambda level: F.when(
        F.col(f"at_{level}.seen") >= MIN_SKETCH, F.col(f"at_{level}")
    )
    chosen = (
        own.join(language, F.col("lang_0").eqNullSafe(F.col("lang_1")), "left")
        .select(
            F.col("lang_0"), F.col("source_0"),
            F.coalesce(enough(0), enough(1), of_all).alias("limits"),
            F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))).alias("part"),
        )
    )
    chosen = keep(chosen, "limits")
    dealt = rows.withColumn("salt", F.pmod(F.xxhash64("doc_id", "n_words", "word_chars"), F.lit(SALTS)))
    met = dealt.join(
        chosen,
        F.col("lang").eqNullSafe(F.col("lang_0"))
        & F.col("source").eqNullSafe(F.col("source_0"))
        & (F.col("salt") == F.col("part")),
        "left",
    )
    broken = F.lit(False)
    for i, f in enumerate(FENCES):
        limit, value = F.col(f"limits.limit_{i}"), F.col(f.measure)
        broken = broken | F.coalesce(value < limit if f.below else value > limit, F.lit(False))
    return met.withColumn("kept", ~F.col("base_failed") & ~broken).select(*rows.columns, "kept")


def assess(docs: DataFrame) -> DataFrame:
    """doc_id, the base counts, ``base_failed``, the measures and ``kept``, a row per document.

    The measures are written once, since both the sketches and the verdicts
    read them; texts are not.
    """
    rows = measured(docs, [F.col("doc_id"), F.col("lang"), F.col("source")])
    return judge(keep(rows, "measures"))


def keep_good(docs: DataFrame) -> DataFrame:
    """The documents that are kept, with all their columns."""
    columns = docs.columns
    rows = measured(docs, [whole_row(docs), F.col("doc_id"), F.col("lang"), F.col("source")])
    return unpack(judge(keep(rows, "measured")).filter("kept"), columns)
