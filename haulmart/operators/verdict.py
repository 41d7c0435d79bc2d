"""Rule verdicts: which landed rows are accepted, which are quarantined and why.

A natural key is taken by the *first acceptable* row in landing order. A row
that comes before it was refused for a reason of its own; a row that comes
after it is a duplicate, whatever else may be wrong with it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmart.functions.render import snapshot

_KEY = "_key"
_OWN = "_own"
_POSITION = "_position"

# Writes rows under a name and reads them back.
Keep = Callable[[DataFrame, str], DataFrame]

REJECT_COLUMNS = ("source_pk", "rule", "description", "raw_payload")


@dataclass(frozen=True)
class Rule:
    """A named check: the condition that *fails* a row and what to record."""

    name: str
    failed: Column
    description: Column | str
    payload: Sequence[str]
    pk: Column | None = None


@dataclass(frozen=True)
class Repeat:
    """What to record for a blank or repeated natural key."""

    description: str
    payload: Sequence[str]
    pk: Column | None = None
    blank: Rule | None = None


def landing_order(*columns: str) -> Column:
    """Sortable landing position; a missing value sorts after all others."""
    return F.struct(
        *[x for c in columns for x in (F.col(c).isNull().alias(f"{c}_missing"), F.col(c))]
    )


def _record(
    pk: Column, name: str, description: Column | str, payload: Sequence[str]
) -> dict[str, Column]:
    text = F.lit(description) if isinstance(description, str) else description
    return {
        "source_pk": F.coalesce(pk.cast("string"), F.lit("")),
        "rule": F.lit(name),
        "description": text,
        "raw_payload": snapshot(*payload),
    }


@dataclass(frozen=True)
class Verdict:
    """Landed rows with their natural key, own fault and landing position."""

    judged: DataFrame
    rules: tuple[Rule, ...]
    repeat: Repeat
    newest_first: bool
    columns: tuple[str, ...]
    order: tuple[str, ...]
    keep: Keep | None = None

    def settled(self, keep: Keep) -> Verdict:
        """The same verdict over judged rows that are written once, lookups and all.

        A position holds nothing that the row does not, so it is not written.
        """
        kept = keep(self.judged.drop(_POSITION), "judged")
        placed = kept.withColumn(_POSITION, landing_order(*self.order))
        return replace(self, judged=placed, keep=keep)

    def slices(self, count: int) -> list[Verdict]:
        """Parts of written rows by hash of the natural key; a key lies in one of them."""
        if count == 1:
            return [self]
        part = F.pmod(F.xxhash64(_KEY), F.lit(count))
        return [replace(self, judged=self.judged.filter(part == n)) for n in range(count)]

    def accepted(self) -> DataFrame:
        """One row per natural key: the first acceptable one.

        Ranking with a limit of one lets Spark keep a single candidate per key
        in every map task, so copies of one key never pile up after the
        shuffle.
        """
        position = F.col(_POSITION)
        order = position.desc() if self.newest_first else position.asc()
        ranked = self.judged.filter((F.col(_KEY) != "") & F.col(_OWN).isNull()).withColumn(
            "_rank", F.row_number().over(Window.partitionBy(_KEY).orderBy(order))
        )
        return ranked.filter(F.col("_rank") == 1).select(*self.columns)

    def rejected(self) -> DataFrame:
        """Every refused row with the rule that refused it."""
        acceptable = F.when(F.col(_OWN).isNull(), F.col(_POSITION))
        first = F.max(acceptable) if self.newest_first else F.min(acceptable)
        # Only a key with several rows can have a row after its winner. Most
        # keys have one, so what meets the rows again is small; both sides come
        # from files, so Spark may split a key that very many rows share.
        repeated_keys = (
            self.judged.filter(F.col(_KEY) != "")
            .groupBy(F.col(_KEY).alias("_of"))
            .agg(first.alias("_winner"), F.count(F.lit(1)).alias("_rows"))
            .filter(F.col("_rows") > 1)
            .drop("_rows")
        )
        if self.keep is not None:
            repeated_keys = self.keep(repeated_keys, "repeated_keys")
        placed = self.judged.join(repeated_keys, F.col(_KEY) == F.col("_of"), "left")
        position, winner = F.col(_POSITION), F.col("_winner")
        after = F.coalesce(
            position < winner if self.newest_first else position > winner, F.lit(False)
        )
        pk = F.col(_KEY) if self.repeat.pk is None else self.repeat.pk
        repeated = _record(pk, "deduplicate", self.repeat.description, self.repeat.payload)
        blank = self.repeat.blank
        nameless = (
            repeated
            if blank is None
            else _record(
                F.col(_KEY) if blank.pk is None else blank.pk,
                blank.name, blank.description, blank.payload,
            )
        )
        # A column of its own for each part of a record: a reader of some parts
        # reads and shuffles nothing that only the others need.
        records = [(F.col(_KEY) == "", nameless), (after, repeated)]
        for number, rule in enumerate(self.rules):
            rule_pk = F.col(_KEY) if rule.pk is None else rule.pk
            record = _record(rule_pk, rule.name, rule.description, rule.payload)
            records.append((F.col(_OWN) == number, record))

        def part(name: str) -> Column:
            found = F.when(records[0][0], records[0][1][name])
            for holds, record in records[1:]:
                found = found.when(holds, record[name])
            return found.alias(name)

        return placed.filter((F.col(_KEY) == "") | after | F.col(_OWN).isNotNull()).select(
            *[part(name) for name in REJECT_COLUMNS]
        )


def judge(
    rows: DataFrame,
    key: Column,
    rules: Sequence[Rule],
    repeat: Repeat,
    order: Sequence[str] = ("extracted_at", "id"),
    newest_first: bool = True,
) -> Verdict:
    """Attach natural key, first failing rule and landing position to ``rows``."""
    # Only the number of the rule is kept; records are made for refused rows.
    own = F.lit(None).cast("int")
    for number, rule in reversed(list(enumerate(rules))):
        own = F.when(rule.failed, F.lit(number)).otherwise(own)
    judged = rows.withColumns(
        {_KEY: key, _OWN: own, _POSITION: landing_order(*order)}
    )
    return Verdict(judged, tuple(rules), repeat, newest_first, tuple(rows.columns), tuple(order))
