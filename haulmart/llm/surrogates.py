"""Personal data replaced by surrogates that keep type, format, gender and script.

Detected entities go by a canonical form (an e-mail address in lower case, a
phone number as its digits, ...), so every mention of one entity in the corpus
gets one surrogate. A surrogate is drawn from a keyed hash of type, canonical
form and draw number. Draws are checked across the whole corpus: two entities
must not get one surrogate, and no surrogate may be another entity of the
corpus. Who loses a collision draws again until none is left.

Names are drawn by part, so "Mrs Anna Wolf" and "Mrs Wolf" keep one surname. A
part has one surrogate whatever the title and the place it stands in, and goes
wherever else its document mentions it.
"""

from __future__ import annotations

import hashlib
import re
import unicodedata
from itertools import groupby

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, IntegerType, StringType, StructField, StructType

from haulmart.llm.shared import keep, unpack, whole_row

KEY = "corpus surrogates"
SALTS = 16
# Draws within an entity's own format; further ones lengthen it.
OWN_FORMAT = 8

# Forms of address, and the gender each tells (f, m, or n for neither).
ADDRESS = {
    "f": ("Mrs", "Ms", "Miss", "Frau", "Mme", "Madame", "Sra", "Señora", "Doña", "г-жа", "госпожа", "κυρία"),
    "m": ("Mr", "Herr", "Monsieur", "Sr", "Señor", "Don", "г-н", "господин", "κύριος"),
    "n": ("Dr", "Prof"),
}
# Syllables of drawn names by script, with endings by gender.
SYLLABLES = {
    "latin": "ba be bi da do el fa ga ha ka la le li lo ma me mi mo na ne ni no ra re ri ro sa se so ta te ti va ve vi za".split(),
    "cyrillic": "ба ве ги да ле ли ло ма ме ми на не ни ра ре ри ро са се та те ти ва ви за".split(),
    "greek": "βα γε δα κα λε λι μα με νι να ρα ρο σα σε τα τε τι θε φι χα".split(),
}
ENDINGS = {
    "latin": {"f": "na", "m": "ron", "n": "len", "s": "mar"},
    "cyrillic": {"f": "на", "m": "рон", "n": "лен", "s": "мар"},
    "greek": {"f": "να", "m": "ρος", "n": "λες", "s": "μαρ"},
}

# Lower-case words inside names, and what a doctor's title may go on with.
PARTICLES = (
    "von", "vom", "und zu", "zu", "zum", "zur", "van", "der", "den", "dem", "de", "del", "della", "dela", "di", "da",
    "do", "dos", "das", "du", "des", "la", "las", "le", "les", "los", "el", "al", "bin", "bint", "ibn", "ben", "y",
    "e", "i", "af", "av", "ter", "ten", "te", "'t", "фон", "ван", "де", "дер", "ди", "да", "ла", "ντε", "ντι", "φον",
)
DEGREES = ("med", "dent", "vet", "phil", "jur", "iur", "rer", "nat", "pol", "oec", "theol", "habil", "h", "c", "hc")

_TITLES = sorted((t for ts in ADDRESS.values() for t in ts), key=len, reverse=True)
_GENDER = {t: g for g, ts in ADDRESS.items() for t in ts}


def _ranges(chars: list[int]) -> str:
    """The code points as ranges of a character class, as Python and Java both read it."""
    runs = [list(g) for _, g in groupby(enumerate(chars), lambda x: x[1] - x[0])]
    spell = lambda c: chr(c) if c > 0x7F else re.escape(chr(c))
    return "".join(f"{spell(run[0][1])}-{spell(run[-1][1])}" for run in runs)


_UPPER = "[" + _ranges([c for c in range(0x20000) if unicodedata.category(chr(c)) in ("Lu", "Lt")]) + "]"
_MARKS = r"[\u0300-\u036f]*"
_LETTERS = r"(?:[^\W\d_]" + _MARKS + ")+"
_GAP = r"[ \t\xa0\u2009\u202f]"
_ADDRESSED = "(?:" + "|".join(_TITLES) + r")\b"
# After a form of address: its dot, white space and degrees.
_AFTER = rf"\.?(?:-Ing\b)?(?:\.{_GAP}*+|{_GAP}++)(?:(?:{'|'.join(DEGREES)})\.{_GAP}*+){{0,12}}+"
# Of a genitive only the name.
_PART = (
    rf"(?!{_ADDRESSED})(?:[dDlL]['’]|[aA]l-|[eE]l-)?{_UPPER}{_MARKS}"
    rf"(?:{_LETTERS}(?:-{_LETTERS}|['’](?!s\b){_LETTERS})*|(?:-{_LETTERS}|['’](?!s\b){_LETTERS})+)"
)
_INITIAL = rf"{_UPPER}(?:\.(?:-?{_UPPER}\.)*|(?={_GAP}++{_UPPER})(?!\w))"
_PARTICLE = rf"(?:(?:{'|'.join(sorted(PARTICLES, key=len, reverse=True))}){_GAP}++)*+"
_NAME = (
    rf"{_PARTICLE}(?:{_PART}|{_INITIAL}|{_UPPER}(?![\w'’-]))"
    rf"(?:(?:{_GAP}++|(?<=\.)){_PARTICLE}(?:{_PART}|(?!{_ADDRESSED}){_INITIAL}))*"
)
_NAME_PART = re.compile(rf"(?<!\w)(?:{_PART}|{_INITIAL}|{_UPPER}(?!\w))")
_SECRETS = "(?:AKIA|ghp_|sk-|xox[bp]-)"
# Every branch is tried once per run of its characters and never gives back what
# it has taken in another way, so that the time grows with the text alone.
_ENTITY = re.compile(
    r"(?P<email>(?<![\w.+%-])[.+%-]*+\w[\w.+%-]*+@[\w-]++(?:\.[\w-]+)*\.[^\W\d_]{2,})"
    r"|(?P<ip>(?<![\w.])(?:(?:25[0-5]|2[0-4]\d|1?\d?\d)\.){3}(?:25[0-5]|2[0-4]\d|1?\d?\d)(?!\.?\w))"
    r"|(?P<phone>(?<![\w+])\+\d{1,3}(?:[ .-]?\(\d{1,4}\))?(?:[ .-]?\d{2,4}){2,4}(?!\w)"
    r"|(?<![\w(])\(\d{3}\)[ .-]?\d{3}[ .-]\d{4}(?!\w)|(?<![\w.-])\d{3}[.-]\d{3}[.-]\d{4}(?![\w-]))"
    r"|(?P<ssn>(?<![\w-])\d{3}-\d{2}-\d{4}(?![\w-]))"
    r"|(?P<iban>\b[A-Z]{2}\d{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)"
    r"|(?P<card>(?<![\w.])\d(?:[ -]?\d){12,18}(?!\w))"
    r"|(?P<secret>(?<!\w)(?=[a-fA-F]*+[0-9])(?=[0-9]*+[a-fA-F])[0-9a-fA-F]{32,128}(?!\w)"
    rf"|\b{_SECRETS}\w{{12,}})"
    rf"|(?P<title>\b{_ADDRESSED}(?:{_AFTER}{_ADDRESSED}){{0,8}}+){_AFTER}(?P<name>{_NAME})"
)
# Whatever holds an entity holds one of these: a digit of any script, the start
# of a secret, or a title. Java's tables may be older than Python's, so digits
# beyond 16 bits are told by Python. Each alternative first looks at one letter.
_FAR_DIGITS = _ranges([c for c in range(0x10000, 0x110000) if unicodedata.category(chr(c)) == "Nd"])
_FIRST = "".join(sorted({t[0] for t in _TITLES} | set("Agsx")))
MAYBE = (
    rf"[\p{{Nd}}@]|(?=[\x{{10000}}-\x{{10FFFF}}])[{_FAR_DIGITS}]"
    rf"|(?=[{_FIRST}])(?:{_SECRETS}|(?:" + "|".join(_TITLES) + rf")(?:-Ing)?(?:\.|{_GAP}))"
)


def canonical(kind: str, surface: str) -> str:
    if kind in ("phone", "ssn", "card"):
        return "".join(c for c in surface if c.isdigit())
    if kind in ("ip", "secret"):
        return surface
    if kind == "iban":
        return surface.replace(" ", "")
    return surface.lower()


def _parts(m: re.Match) -> list[tuple[int, int, str, str]]:
    """The parts of a name that follows forms of address.

    The last that is no initial is the surname. Names that a hyphen joins are
    parts of their own.
    """
    told = {_GENDER[t] for t in re.findall(_ADDRESSED, m["title"])} - {"n"}
    gender = told.pop() if len(told) == 1 else "n"
    parts = [(m.start("name") + p.start(), p.group()) for p in _NAME_PART.finditer(m["name"])]
    whole = {i: p for i, (_, p) in enumerate(parts) if re.fullmatch(_PART, p)}
    surname = max(whole, default=-1)
    found = []
    for i, (at, part) in enumerate(parts):
        if i not in whole:
            found.append((at, at + len(part), "initial", canonical("initial", part)))
            continue
        kind = "surname" if i == surname else f"given_{gender}"
        for piece in re.split(rf"(?<=\w\w)-(?={_UPPER}\w)", part):
            found.append((at, at + len(piece), kind, canonical(kind, piece)))
            at += len(piece) + 1
    return found


def entities(text: str | None) -> list[tuple[int, int, str, str]]:
    """(start, end, type, canonical form), in order and not overlapping.

    The parts of a name come one by one: initials, given names with the
    address's gender (given_f, given_m, given_n), and a surname. Their further
    mentions in the text, with or without an address, are entities too.
    """
    text = text or ""
    found, names = [], {}
    for m in _ENTITY.finditer(text):
        kind = m.lastgroup
        if kind != "name":
            found.append((m.start(), m.end(), kind, canonical(kind, m.group())))
            continue
        for part in _parts(m):
            found.append(part)
            if part[2] != "initial":
                names.setdefault(part[3], "surname" if part[2] == "surname" else "given_n")
    if not names:
        return found
    surfaces = {text[a:b] for a, b, kind, _ in found if kind == "surname" or kind.startswith("given")}
    spelt = "|".join(map(re.escape, sorted({*names, *surfaces}, key=len, reverse=True)))
    taken, more = iter([*found, (len(text) + 1, 0, "", "")]), []
    start, end, *_ = next(taken)
    # A genitive without an apostrophe keeps its s.
    for m in re.finditer(rf"(?<!\w)(?:{spelt})(?=s?(?!\w))", text, re.IGNORECASE):
        while end and end <= m.start():
            start, end, *_ = next(taken)
        said = m.group()
        if m.end() <= start and (said[0].isupper() or said in surfaces) and said.lower() in names:
            more.append((m.start(), m.end(), names[said.lower()], said.lower()))
    return sorted(found + more)


class _Draw:
    """Keyed, endless and repeatable choices for one draw of one entity."""

    def __init__(self, key: str, *of: str) -> None:
        self._seed = "\x1f".join(of).encode("utf-8", "surrogatepass")
        self._key, self._block, self._held = key.encode()[:64], 0, 0
        self._left = 0

    def below(self, n: int) -> int:
        if self._left < n << 32:
            made = hashlib.blake2b(self._seed + self._block.to_bytes(8, "big"), key=self._key)
            self._held, self._left, self._block = int.from_bytes(made.digest(), "big"), 1 << 512, self._block + 1
        self._held, out = divmod(self._held, n)
        self._left //= n
        return out


def _luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _alike(text: str, draw: _Draw) -> str:
    """Digits for digits and letters for letters of the same case."""
    out = []
    for c in text:
        if c.isdigit():
            out.append(str(draw.below(10)))
        elif c.isalpha():
            letter = "abcdefghijklmnopqrstuvwxyz"[draw.below(26)]
            out.append(letter.upper() if c.isupper() else letter)
        else:
            out.append(c)
    return "".join(out)


def _script(text: str) -> str:
    for c in text:
        if "Ѐ" <= c <= "ӿ":
            return "cyrillic"
        if "Ͱ" <= c <= "Ͽ" or "ἀ" <= c <= "῿":
            return "greek"
    return "latin"


def surrogate(key: str, kind: str, value: str, number: int) -> str:
    """The canonical surrogate of a canonical entity at its draw ``number``.

    Where the values of a format are as good as used up, ``OWN_FORMAT`` draws
    fail. Each further one is longer by a digit or letter (an IPv4 address by a
    whole number), so every entity finds a value in the end.
    """
    draw = _Draw(key, kind, value, str(number))
    longer = max(0, number + 1 - OWN_FORMAT)
    if longer and kind == "email":
        local, _, domain = value.rpartition("@")
        value = f"{local}{'x' * longer}@{domain}"
    elif longer and kind in ("phone", "ssn", "card", "iban", "secret"):
        value += "0" * longer
    if kind == "email":
        local, _, domain = value.rpartition("@")
        # A domain is drawn by itself, so addresses that share one still do.
        label = _alike(domain.split(".")[0], _Draw(key, "domain", domain))
        top = domain.rpartition(".")[2]
        return f"{_alike(local, draw)}@{label}.example.{top if top in ('com', 'net', 'org') else 'com'}"
    if kind == "ip":
        first = value.split(".")[0]
        head = [first] if first in ("10", "127") else [str(1 + draw.below(223))]
        return ".".join(head + [str(1 + draw.below(254)) for _ in range(3 + longer)])
    if kind == "phone":
        # An international number keeps its country code's first digit.
        held = 1 if len(value) > 10 else 0
        return value[:held] + _alike(value[held:], draw)
    if kind == "card":
        body = value[0] + _alike(value[1:-1], draw)
        if not _luhn(value):
            return body + _alike(value[-1], draw)
        return next(body + str(d) for d in range(10) if _luhn(body + str(d)))
    if kind == "iban":
        return value[:2] + _alike(value[2:], draw)
    if kind == "secret":
        if re.fullmatch(r"[0-9a-fA-F]+", value):
            made = "".join("0123456789abcdef"[draw.below(16)] for _ in value)
            return made.upper() if value.upper() == value else made
        return value[:4] + _alike(value[4:], draw)
    if kind == "ssn":
        return _alike(value, draw)
    script = _script(value)
    parts = SYLLABLES[script]
    if kind == "initial":
        letters = sorted({p[0] for p in parts})
        other = lambda c: [x for x in letters if x != c]
        return "".join(other(c)[draw.below(len(other(c)))] if c.isalpha() else c for c in value)
    syllables = 2 + number // 3 + draw.below(2)
    ending = ENDINGS[script]["s" if kind == "surname" else kind[-1]]
    return "".join(parts[draw.below(len(parts))] for _ in range(syllables)) + ending


def render(surface: str, kind: str, chosen: str) -> str:
    """A canonical surrogate in the format in which the entity stands in the text."""
    if kind in ("phone", "ssn", "card", "iban"):
        left = iter(chosen)
        # A longer one than the entity ends with what is left over.
        return "".join([*(next(left) if c.isalnum() else c for c in surface), *left])
    if kind in ("ip", "secret"):
        return chosen
    if surface.isupper() or kind == "initial":
        return chosen.upper()
    named = kind.startswith(("given", "surname")) and any(c.isupper() for c in surface)
    return chosen.title() if named else chosen


def rewritten(text: str, spans: list) -> str:
    """``text`` with (start, end, type, surrogate) spans replaced."""
    out, at = [], 0
    for start, end, kind, chosen in sorted(spans, key=lambda s: s[0]):
        out += [text[at:start], render(text[start:end], kind, chosen)]
        at = end
    return "".join([*out, text[at:]])


_SPAN = StructType([
    StructField("start", IntegerType()), StructField("end", IntegerType()),
    StructField("kind", StringType()), StructField("value", StringType()),
])


def detector():
    def detect(texts: pd.Series) -> pd.Series:
        return pd.Series(
            [[dict(zip(_SPAN.fieldNames(), e)) for e in entities(t)] for t in texts], dtype=object
        )

    return F.pandas_udf(detect, ArrayType(_SPAN))


def _drawer(key: str):
    def draw(kinds: pd.Series, values: pd.Series, numbers: pd.Series) -> pd.Series:
        return pd.Series(
            [surrogate(key, k, v, int(n)) for k, v, n in zip(kinds, values, numbers)], dtype=object
        )

    return F.pandas_udf(draw, StringType())


def _space() -> Column:
    """Names are one space whatever their gender and place, so no two people merge."""
    named = F.col("kind").startswith("given") | (F.col("kind") == "surname")
    return F.when(named, F.lit("name")).otherwise(F.col("kind"))


def known_once(each: DataFrame) -> DataFrame:
    """(kind, value), a row for each entity of the mentions ``each``.

    A name is of the gender that its forms of address tell, of neither where
    they tell both or none, and a surname where it is nothing else.
    """
    said = lambda k: F.max(F.col("kind") == k)
    seen = each.groupBy(_space().alias("space"), "value").agg(
        said("given_f").alias("f"), said("given_m").alias("m"), said("given_n").alias("n")
    )
    kind = (
        F.when(F.col("space") != "name", F.col("space"))
        .when(F.col("f") & ~F.col("m"), "given_f")
        .when(F.col("m") & ~F.col("f"), "given_m")
        .when(F.col("f") | F.col("n"), "given_n")
        .otherwise("surname")
    )
    return seen.select(kind.alias("kind"), "value")


def assign(known: DataFrame, key: str = KEY) -> DataFrame:
    """(kind, value, chosen) for distinct entities (kind, value), free of collisions.

    Of the entities that draw one surrogate, one that has held it stays, else
    the least. A surrogate that is an entity of the corpus is always given up.
    Each round writes its draws to the shared folder. As draws lengthen a
    crowded format, the rounds end.
    """
    known = known.withColumn("space", _space())
    real = known.select(F.col("space").alias("real_space"), F.col("value").alias("real_value")).distinct()
    draw = _drawer(key)
    now = known.withColumn("number", F.lit(0)).withColumn("settled", F.lit(False))
    while True:
        drawn = keep(now.withColumn("chosen", draw("kind", "value", "number")), "draws")
        first = drawn.groupBy(F.col("space").alias("s"), F.col("chosen").alias("c")).agg(
            F.min(F.struct(~F.col("settled"), "kind", "value")).alias("first")
        )
        judged = (
            drawn.join(first, (F.col("space") == F.col("s")) & (F.col("chosen") == F.col("c")))
            .join(
                real,
                (F.col("space") == F.col("real_space")) & (F.col("chosen") == F.col("real_value")),
                "left",
            )
            .withColumn(
                "fine",
                F.col("real_value").isNull()
                & (F.col("first.kind") == F.col("kind")) & (F.col("first.value") == F.col("value")),
            )
        )
        now = keep(
            judged.select(
                "kind", "value", "space", "chosen", F.col("fine").alias("settled"),
                F.when(F.col("fine"), F.col("number")).otherwise(F.col("number") + 1).alias("number"),
            ),
            "judged",
        )
        if now.filter(~F.col("settled")).isEmpty():
            return now.select("kind", "value", "chosen")
        now = now.drop("chosen")


def replaced(docs: DataFrame, key: str = KEY) -> tuple[DataFrame, DataFrame]:
    """The documents as (row, text, n_entities), and the (kind, value, chosen) used.

    ``row`` is the input row as it was. Only documents that can hold an entity
    leave the scan: they are written with their entities, joined with the
    surrogates and put together again. The others pass through. Null texts stay
    null, empty ones empty; repeated rows come out repeated.
    """
    rows = docs.select(whole_row(docs))
    text = F.col("row").getField("text")
    maybe = F.coalesce(text.rlike(MAYBE), F.lit(False))
    held = rows.filter(maybe).withColumn("spans", detector()(text))
    held = keep(held.withColumn("at", F.monotonically_increasing_id()), "entities")
    # Initials are too few to be told apart; each is drawn where it stands.
    shared = F.filter("spans", lambda x: x["kind"] != "initial")
    each = held.select("at", F.explode(shared).alias("x")).select("at", "x.*")
    chosen = assign(known_once(each.select("kind", "value")), key)

    # A mention in a third of all documents is dealt to several parts.
    parts = chosen.withColumn("part", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    parts = parts.select(_space().alias("space"), "value", "part", "chosen")
    met = each.withColumns({"space": _space(), "part": F.pmod(F.col("at"), F.lit(SALTS)).cast("int")}).join(
        parts, ["space", "value", "part"]
    )
    spans = met.groupBy(F.col("at").alias("of")).agg(
        F.collect_list(F.struct("start", "end", "kind", "chosen")).alias("new")
    )

    def rewrite(texts: pd.Series, spans: pd.Series, initials: pd.Series) -> pd.Series:
        out = []
        for t, s, own in zip(texts, spans, initials):
            new = [] if s is None else [(x["start"], x["end"], x["kind"], x["chosen"]) for x in s]
            for x in own:
                new.append((x["start"], x["end"], x["kind"], surrogate(key, x["kind"], x["value"], 0)))
            out.append(rewritten(t, new) if new else t)
        return pd.Series(out, dtype=object)

    put = F.pandas_udf(rewrite, StringType())
    done = held.join(spans, F.col("at") == F.col("of"), "left").select(
        "row", put(text, F.col("new"), F.filter("spans", lambda x: x["kind"] == "initial")).alias("text"), F.size("spans").cast("long").alias("n_entities")
    )
    plain = rows.filter(~maybe).select("row", text.alias("text"), F.lit(0).cast("long").alias("n_entities"))
    return plain.unionByName(done), chosen


def with_surrogates(docs: DataFrame, key: str = KEY) -> DataFrame:
    """The documents with replaced texts; ``n_chars``, where there is one, follows the text."""
    out, _ = replaced(docs, key)
    given = lambda c: F.col("row").getField(c)
    values = {c: given(c) for c in docs.columns} | {"text": F.col("text")}
    if "n_chars" in docs.columns:
        changed = F.length("text").cast(docs.schema["n_chars"].dataType)
        values["n_chars"] = F.when(F.col("n_entities") > 0, changed).otherwise(given("n_chars"))
    return out.select(*[v.alias(c) for c, v in values.items()])
