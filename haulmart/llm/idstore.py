"""Token ids in raw binary files, with a minimal perfect hash index over the keys.

Payload files hold nothing but little-endian 16-bit ids, document after
document in ascending doc_id order. The index is cut into buckets by the hash
of the key. A bucket's file maps each of its keys, in constant time and with no
stored keys, to a slot of an array of (fingerprint, file number, offset, count);
a key that was never stored fails the fingerprint but for one in 2**32.

Files go to the shared folder through Arrow's file systems. Each task attempt
writes under a name of its own, and the table of entries, written after, names
the files that count; what a lost attempt left is never read.
"""

from __future__ import annotations

import json
import math
import re
import uuid
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass
from itertools import chain

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from haulmart.llm.shared import Remembered, fresh_path, keep

END_ID = 2
WIDTH = np.dtype("<u2")
# Keys of one index bucket; its file is some 20 bytes a key.
BUCKET_KEYS = 500_000
# Bits of a level for each key that is left.
GAMMA = 2.0
MAX_LEVELS = 32
# Encoded words that a worker remembers between batches, and texts that it encodes at a time.
REMEMBERED = 1_500_000
TEXTS = 1_000
# What the tokenizer takes for white space. Python's also has U+001C to U+001F,
# which the tokenizer gives ids.
_WHITE = re.compile("[\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]+")
_NOT_WHITE = re.compile("[\x1c-\x1f]")
# Letters and then signs, none of them an apostrophe, which may begin a unit with letters.
_TAILED = re.compile(r"([^\W\d_]+)([!-&(-/:-@[-`{-~]+)")
_ENTRY = np.dtype([("mark", "<u4"), ("file", "<u4"), ("offset", "<u8"), ("count", "<u4")])


def cut_words(text: str) -> list[str]:
    """The words of a text, cut at the tokenizer's white space."""
    if _NOT_WHITE.search(text):
        return [w for w in _WHITE.split(text) if w]
    return text.split()


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


class WordEncoder:
    """Whole texts encoded by a tokenizer that drops white space, word by word.

    White space always ends a word and leaves no id, so a text's ids are those
    of its words in a row, and a word is given to the tokenizer once. So does
    the end of letters before signs, which parts "word," from its comma; only
    where a letter's lower case has a mark, as that of U+0130, they stay together.

    Words of letters only are one unit of the vocabulary's merges, whose last id
    is marked as a word's end; many of them are encoded in one call and cut
    there.
    """

    def __init__(self, path: str) -> None:
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(path)
        if self._tokenizer.get_vocab_size() > 1 << 16:
            raise ValueError("ids of this vocabulary do not fit 16 bits")
        vocabulary = self._tokenizer.get_vocab(with_added_tokens=True)
        self._ends = np.zeros(max(vocabulary.values()) + 1, bool)
        self._ends[[i for token, i in vocabulary.items() if token.endswith("</w>")]] = True
        self._remembered = Remembered(REMEMBERED)

    def _one_by_one(self, words: list[str]) -> Iterator[tuple[str, bytes]]:
        made = self._tokenizer.encode_batch_fast(words, add_special_tokens=False)
        # One array for all: making one for each costs more than what it holds.
        ids = [m.ids for m in made]
        data = np.fromiter(chain.from_iterable(ids), WIDTH).tobytes()
        at = 0
        for word, own in zip(words, ids):
            end = at + len(own) * WIDTH.itemsize
            yield word, data[at:end]
            at = end

    def _together(self, words: list[str]) -> Iterable[tuple[str, bytes]]:
        made = self._tokenizer.encode_batch_fast([" ".join(words)], add_special_tokens=False)[0]
        ids = np.array(made.ids, WIDTH)
        ends = (np.flatnonzero(self._ends[ids]) + 1) * WIDTH.itemsize
        if len(ends) != len(words):
            # Some word is several units once it is normalised.
            return self._one_by_one(words)
        data, cuts = ids.tobytes(), [0, *ends.tolist()]
        return zip(words, (data[a:b] for a, b in zip(cuts, cuts[1:])))

    def _learn(self, new: set[str]) -> None:
        words = self._remembered.values
        tailed = []
        for word in new:
            if word.isalpha():
                continue
            # The lower case of a letter may be letter and mark, which join the sign.
            cut = _TAILED.fullmatch(word)
            if cut is not None and cut[1].lower().isalpha():
                tailed.append((word, cut[1], cut[2]))
        new = new.difference(w for w, _, _ in tailed)
        new.update(part for _, *parts in tailed for part in parts if part not in words)
        # The tokenizer lowers letters first; of ASCII words, each is encoded in one case.
        capital = {w: low for w in new if w.isascii() and (low := w.lower()) != w}
        new = new.difference(capital)
        new.update(low for low in capital.values() if low not in words)
        plain = [w for w in new if w.isalpha()]
        for at in range(0, len(plain), 4096):
            words.update(self._together(plain[at : at + 4096]))
        mixed = [w for w in new if not w.isalpha()]
        for at in range(0, len(mixed), 4096):
            words.update(self._one_by_one(mixed[at : at + 4096]))
        for word, low in capital.items():
            words[word] = words[low]
        for word, letters, signs in tailed:
            words[word] = words[letters] + words[signs]

    def payloads(self, texts: list[str | None]) -> Iterator[bytes]:
        """The ids of each text with the end id, as bytes; a null text has the end id only."""
        end = np.array([END_ID], WIDTH).tobytes()
        for at in range(0, len(texts), TEXTS):
            cut = [cut_words(t or "") for t in texts[at : at + TEXTS]]
            self._learn(self._remembered.unknown(cut))
            of = self._remembered.values.__getitem__
            for row in cut:
                yield b"".join([*map(of, row), end])
            self._remembered.trim()


_encoders: dict[str, WordEncoder] = {}


def word_encoder(path: str) -> WordEncoder:
    """The encoder of a path, once per worker process."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]


# --- the hash function ------------------------------------------------------


def _mixed(keys: np.ndarray, level: int) -> np.ndarray:
    x = keys + np.uint64((level + 1) * 0x9E3779B97F4A7C15 % (1 << 64))
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


@dataclass
class PerfectHash:
    """Levels of bits: a key sits at its bit of the first level where it was alone.

    Its number is the count of set bits before that one. Keys that shared their
    bits on all levels are listed in ``rest`` and numbered last.
    """

    levels: list[np.ndarray]
    rest: np.ndarray

    @classmethod
    def build(cls, keys: np.ndarray) -> PerfectHash:
        levels, left = [], np.sort(keys)
        while len(left) and len(levels) < MAX_LEVELS:
            size = max(64, int(len(left) * GAMMA))
            place = (_mixed(left, len(levels)) % np.uint64(size)).astype(np.int64)
            alone = np.bincount(place, minlength=size) == 1
            levels.append(alone)
            left = left[~alone[place]]
        return cls(levels, left)

    def numbers(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key; any number, or -1, for a key that is not in it."""
        out = np.full(len(keys), -1, np.int64)
        open_, before = np.arange(len(keys)), 0
        for level, alone in enumerate(self.levels):
            rank = np.cumsum(alone) - 1
            place = (_mixed(keys[open_], level) % np.uint64(len(alone))).astype(np.int64)
            hit = alone[place]
            out[open_[hit]] = before + rank[place[hit]]
            open_ = open_[~hit]
            before += int(rank[-1]) + 1
        if len(self.rest) and len(open_):
            at = np.searchsorted(self.rest, keys[open_])
            at[at == len(self.rest)] = 0
            same = self.rest[at] == keys[open_]
            out[open_[same]] = before + at[same]
        return out

    def to_bytes(self) -> bytes:
        head = json.dumps([[len(x) for x in self.levels], len(self.rest)]).encode()
        bits = [np.packbits(x).tobytes() for x in self.levels]
        return b"".join([len(head).to_bytes(4, "little"), head, *bits, self.rest.astype("<u8").tobytes()])

    @classmethod
    def from_bytes(cls, data: bytes) -> tuple[PerfectHash, int]:
        at = 4 + int.from_bytes(data[:4], "little")
        sizes, rest = json.loads(data[4:at])
        levels = []
        for size in sizes:
            held = (size + 7) // 8
            levels.append(np.unpackbits(np.frombuffer(data, np.uint8, held, at), count=size).astype(bool))
            at += held
        return cls(levels, np.frombuffer(data, "<u8", rest, at)), at + 8 * rest


def index_bytes(keys: np.ndarray, entries: np.ndarray) -> bytes:
    """A bucket's file. Keys that share all 64 bits keep the last one's entry apart by its mark."""
    unique, first = np.unique(keys, return_index=True)
    made = PerfectHash.build(unique)
    slots = np.zeros(len(unique), _ENTRY)
    slots[made.numbers(unique)] = entries[first]
    twins = np.setdiff1d(np.arange(len(keys)), first)
    extra = np.zeros(len(twins), [("key", "<u8"), *_ENTRY.descr])
    extra["key"] = keys[twins]
    for name in _ENTRY.names:
        extra[name] = entries[name][twins]
    head = np.array([len(slots), len(extra)], "<u8").tobytes()
    return made.to_bytes() + head + slots.tobytes() + extra.tobytes()


def looked_up(data: bytes, keys: np.ndarray, marks: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(found, entries) of keys in a bucket's file."""
    made, at = PerfectHash.from_bytes(data)
    n, more = np.frombuffer(data, "<u8", 2, at).tolist()
    slots = np.frombuffer(data, _ENTRY, n, at + 16)
    extra = np.frombuffer(data, [("key", "<u8"), *_ENTRY.descr], more, at + 16 + n * _ENTRY.itemsize)
    numbers = made.numbers(keys)
    entries = slots[np.maximum(numbers, 0)].copy() if n else np.zeros(len(keys), _ENTRY)
    found = (numbers >= 0) & (entries["mark"] == marks) if n else np.zeros(len(keys), bool)
    for i in np.flatnonzero(~found) if more else ():
        for row in extra[(extra["key"] == keys[i]) & (extra["mark"] == marks[i])][:1]:
            entries[i] = tuple(row[name] for name in _ENTRY.names)
            found[i] = True
    return found, entries


# --- files ------------------------------------------------------------------


def _opened(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def _write_payloads(root: str, encode: str) -> Callable:
    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _opened(root)
        part = TaskContext.get().partitionId()
        name = f"ids-{part:06d}-{uuid.uuid4().hex}.bin"
        coder, out, offset = word_encoder(encode), None, 0
        try:
            for batch in batches:
                payloads = list(coder.payloads(batch.column("text").to_pylist()))
                if out is None and payloads:
                    system.create_dir(folder, recursive=True)
                    out = system.open_output_stream(f"{folder}/{name}")
                counts = np.array([len(p) // WIDTH.itemsize for p in payloads], np.int64)
                if out is not None:
                    out.write(b"".join(payloads))
                offsets = offset + np.cumsum(counts) - counts
                offset += int(counts.sum())
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column("doc_id"), batch.column("copy"),
                        pa.array([name] * len(counts), pa.string()),
                        pa.array([part] * len(counts), pa.int32()), pa.array(offsets), pa.array(counts),
                    ],
                    ["doc_id", "copy", "file", "part", "offset", "count"],
                )
        finally:
            if out is not None:
                out.close()

    return write


@dataclass(frozen=True)
class IdStore:
    """Written ids: the folder, its files in order and the buckets of its index."""

    root: str
    files: DataFrame
    buckets: DataFrame
    n_buckets: int


def _key() -> list[Column]:
    """The hash and the fingerprint of (doc_id, copy)."""
    return [F.xxhash64("doc_id", "copy").alias("key"), F.hash("copy", "doc_id").alias("mark")]


def numbered_copies(ids: DataFrame) -> DataFrame:
    """``ids`` with ``copy``: 0, 1, ... among the rows of one doc_id.

    Ids that stand alone, which is all of them in a sound table, skip the window.
    """
    twice = keep(
        ids.groupBy(F.col("doc_id").alias("of")).agg(F.count(F.lit(1)).alias("n")).filter("n > 1"), "repeated"
    )
    if twice.isEmpty():
        return ids.withColumn("copy", F.lit(0).cast("long"))
    rank = Window.partitionBy("doc_id").orderBy(*ids.columns)
    mine = F.col("doc_id").eqNullSafe(F.col("of"))
    repeated = ids.join(twice, mine, "left_semi").withColumn("copy", F.row_number().over(rank).cast("long") - 1)
    return ids.join(twice, mine, "left_anti").withColumn("copy", F.lit(0).cast("long")).unionByName(repeated)


def write(docs: DataFrame, tokenizer: str | None = None, bucket_keys: int = BUCKET_KEYS) -> IdStore:
    """Encode whole texts (null: empty), end each with id 2, and store them by doc_id.

    Null ids come first. Rows of one doc_id are stored each, in the order of
    their texts. The range exchange moves texts, so the encoder runs once.
    """
    spark = docs.sparkSession
    root = fresh_path(spark, "ids")
    rows = numbered_copies(docs.select("doc_id", "text"))
    ordered = rows.repartitionByRange("doc_id", "copy").sortWithinPartitions("doc_id", "copy")
    id_type = docs.schema["doc_id"].dataType.simpleString()
    schema = f"doc_id {id_type}, copy long, file string, part int, offset long, count long"
    entries = keep(ordered.mapInArrow(_write_payloads(root, tokenizer or tokenizer_path()), schema), "entries")

    # One row per file from here to the next paragraph.
    per_file = entries.groupBy("part", "file").agg(F.sum("count").alias("ids"), F.count(F.lit(1)).alias("rows"))
    order = Window.orderBy("part")
    files = keep(
        per_file.select(
            F.row_number().over(order).alias("number"), "file",
            F.coalesce(F.sum("ids").over(order.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("before"),
            "rows",
        ),
        "files",
    )

    total = files.agg(F.sum("rows")).first()[0] or 0
    n_buckets = max(1, math.ceil(total / bucket_keys))
    keyed = entries.join(F.broadcast(files.select("file", "number")), "file").select(
        *_key(), "number", "offset", "count"
    )
    keyed = keyed.withColumn("bucket", F.pmod(F.shiftrightunsigned("key", 32), F.lit(n_buckets)))

    def build(table: pa.Table) -> pa.Table:
        part = {c: table.column(c).to_numpy() for c in table.column_names}
        made = np.zeros(len(table), _ENTRY)
        made["mark"], made["file"] = part["mark"].astype(np.int32).view(np.uint32), part["number"]
        made["offset"], made["count"] = part["offset"], part["count"]
        system, folder = _opened(root)
        name = f"index-{int(part['bucket'][0]):06d}-{uuid.uuid4().hex}.mph"
        with system.open_output_stream(f"{folder}/{name}") as out:
            out.write(index_bytes(part["key"].astype(np.int64).view(np.uint64), made))
        return pa.table({"bucket": pa.array([part["bucket"][0]], pa.int64()), "index": [name]})

    buckets = keep(keyed.groupBy("bucket").applyInArrow(build, "bucket long, index string"), "buckets")
    return IdStore(root, files, buckets, n_buckets)


def lookup(store: IdStore, keys: DataFrame) -> DataFrame:
    """(doc_id, copy, number, offset, count) of the keys (doc_id, copy) that are stored."""
    root, id_type = store.root, keys.schema["doc_id"].dataType.simpleString()
    asked = keys.select("doc_id", "copy", *_key()).withColumn(
        "bucket", F.pmod(F.shiftrightunsigned("key", 32), F.lit(store.n_buckets))
    )
    # A row per bucket names its file; keys are dealt to their buckets.
    routed = asked.join(F.broadcast(store.buckets), "bucket").repartition("index").sortWithinPartitions("index")

    def find(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _opened(root)
        held, data = None, b""
        for batch in batches:
            names = batch.column("index").to_pylist()
            cuts = [0, *[i for i in range(1, len(names)) if names[i] != names[i - 1]], len(names)]
            for a, b in zip(cuts, cuts[1:]):
                if a == b:
                    continue
                if names[a] != held:
                    held = names[a]
                    with system.open_input_file(f"{folder}/{held}") as source:
                        data = source.read()
                part = batch.slice(a, b - a)
                key = part.column("key").to_numpy().view(np.uint64)
                mark = part.column("mark").to_numpy().view(np.uint32)
                found, entry = looked_up(data, key, mark)
                where, entry = pa.array(np.flatnonzero(found)), entry[found]
                yield pa.RecordBatch.from_arrays(
                    [
                        part.column("doc_id").take(where), part.column("copy").take(where),
                        pa.array(entry["file"].astype(np.int32)),
                        pa.array(entry["offset"].astype(np.int64)), pa.array(entry["count"].astype(np.int64)),
                    ],
                    ["doc_id", "copy", "number", "offset", "count"],
                )

    schema = f"doc_id {id_type}, copy long, number int, offset long, count long"
    return routed.select("doc_id", "copy", "key", "mark", "index").mapInArrow(find, schema)


def read(store: IdStore, keys: DataFrame, made: Callable[[np.ndarray], object], made_type: str) -> DataFrame:
    """doc_id, start, n_tokens and ``made`` of the ids of each stored key.

    Keys are looked up in the index, dealt by file and read in file order, in
    stretches of a task's sorted rows.
    """
    root, id_type = store.root, keys.schema["doc_id"].dataType.simpleString()
    places = lookup(store, keys).join(F.broadcast(store.files.select("number", "file", "before")), "number")
    # A file is dealt to several tasks by the stretch of ids that an entry begins in.
    stretch = F.expr("offset div 4194304")
    routed = places.repartition("number", stretch).sortWithinPartitions("number", "offset")
    arrow_type = {"long": pa.int64(), "array<int>": pa.list_(pa.int32())}[made_type]

    def load(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        system, folder = _opened(root)
        held, source = None, None
        try:
            for batch in batches:
                out = []
                columns = (batch.column(c).to_pylist() for c in ("file", "offset", "count"))
                for name, offset, count in zip(*columns):
                    if name != held:
                        if source is not None:
                            source.close()
                        held, source = name, system.open_input_file(f"{folder}/{name}")
                    data = source.read_at(count * WIDTH.itemsize, offset * WIDTH.itemsize)
                    out.append(made(np.frombuffer(data, WIDTH)))
                start = pa.compute.add(batch.column("before"), batch.column("offset"))
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id"), start, batch.column("count"), pa.array(out, arrow_type)],
                    ["doc_id", "start", "n_tokens", "made"],
                )
        finally:
            if source is not None:
                source.close()

    return routed.mapInArrow(load, f"doc_id {id_type}, start long, n_tokens long, made {made_type}")


def ids_crc32(ids: np.ndarray) -> int:
    return zlib.crc32(ids.astype("<u4").tobytes())


def stored_digests(docs: DataFrame, tokenizer: str | None = None, bucket_keys: int = BUCKET_KEYS) -> DataFrame:
    """doc_id, start, n_tokens and ids_crc32 of each document, read back by its key."""
    store = write(docs, tokenizer, bucket_keys)
    keys = numbered_copies(docs.select("doc_id"))
    return read(store, keys, ids_crc32, "long").withColumnRenamed("made", "ids_crc32")
