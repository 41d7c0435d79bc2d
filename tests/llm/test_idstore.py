import unicodedata
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from haulmart.llm import idstore

TOKENIZER = Tokenizer.from_file(idstore.tokenizer_path())
TEXTS = [
    None, "", " \n\t ", "The end. The end, the END!", "don't 's 12 3a4 ...!? <|endoftext|> <|startoftext|>x",
    "É é́ İstanbul ΣΑΣ 中文字 ﬁ 😀👍🏽 a b c", "word. word, word; (word) word.) .word", "x" * 9000,
    " ".join(f"{a}{b}" for a in "thequickbrown" for b in "jumpsoverlazy"),
]


def brute(rows):
    out, start = [], 0
    order = lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or "")
    for doc_id, text, *_ in sorted(rows, key=order):
        ids = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [2]
        out.append((doc_id, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes())))
        start += len(ids)
    return out


def test_words_in_a_row_equal_whole_texts():
    made = idstore.WordEncoder(idstore.tokenizer_path()).payloads(TEXTS)
    for text, payload in zip(TEXTS, made):
        want = TOKENIZER.encode(text or "", add_special_tokens=False).ids + [idstore.END_ID]
        assert np.frombuffer(payload, idstore.WIDTH).tolist() == want


def test_every_control_and_space_equals_the_library():
    odd = [c for c in map(chr, range(0x110000)) if c.isspace() or unicodedata.category(c) in ("Cc", "Cf", "Zs", "Zl", "Zp")]
    assert {*map(chr, range(0x20)), "\x7f", "\x85", "\u200b", "\u2028", "\u3000"} <= set(odd)
    texts = [
        t for c in odd
        for t in (f"page one{c}page two", f"{c}one {c} two, {c}", f"it{c}'s{c}{c}12{c}.{c}Mix\x1c{c}ed\x1f, end", c)
    ]
    made = idstore.WordEncoder(idstore.tokenizer_path()).payloads(texts)
    for text, payload in zip(texts, made):
        want = TOKENIZER.encode(text, add_special_tokens=False).ids + [idstore.END_ID]
        assert np.frombuffer(payload, idstore.WIDTH).tolist() == want, repr(text)


@pytest.mark.parametrize("bucket_keys", [40, 500_000])
def test_read_back_in_order(docs_of, bucket_keys):
    rows = [(i * 3 - 50, t, "en", "s") for i, t in enumerate(TEXTS * 12)]
    got = idstore.stored_digests(docs_of(rows), bucket_keys=bucket_keys).collect()
    assert sorted(map(tuple, got)) == brute(rows)


def test_odd_rows_and_repeated_ids(docs_of, odd_rows):
    docs = docs_of(odd_rows, clashing=True)
    got = idstore.stored_digests(docs).select("doc_id", "start", "n_tokens", "ids_crc32").collect()
    assert sorted(map(tuple, got), key=lambda r: r[1]) == brute(odd_rows)
    assert idstore.stored_digests(docs.limit(0)).count() == 0


def test_unknown_keys_are_not_found(spark, docs_of):
    store = idstore.write(docs_of([(i, f"text {i}", "en", "s") for i in range(200)]))
    keys = spark.range(150, 1000).select(F.col("id").alias("doc_id"), F.lit(0).cast("long").alias("copy"))
    assert sorted(r.doc_id for r in idstore.lookup(store, keys).collect()) == list(range(150, 200))
    ids = idstore.read(store, keys, lambda x: x.tolist(), "array<int>").filter("doc_id = 160").first().made
    assert ids == TOKENIZER.encode("text 160", add_special_tokens=False).ids + [2]


@pytest.mark.parametrize("n", [0, 1, 2, 1000, 50_000])
def test_the_hash_is_minimal_and_perfect(n):
    keys = np.unique(np.random.default_rng(n).integers(0, 1 << 63, n, np.int64)).astype(np.uint64)
    made, _ = idstore.PerfectHash.from_bytes(idstore.PerfectHash.build(keys).to_bytes())
    assert sorted(made.numbers(keys).tolist()) == list(range(len(keys)))


def test_keys_of_one_hash_are_told_apart(monkeypatch):
    keys = np.array([5, 5, 7, 5], np.uint64)
    entries = np.zeros(4, idstore._ENTRY)
    entries["mark"], entries["offset"] = [1, 2, 3, 4], [10, 20, 30, 40]
    monkeypatch.setattr(idstore, "MAX_LEVELS", 1)
    data = idstore.index_bytes(keys, entries)
    found, got = idstore.looked_up(data, np.r_[keys, keys[:1]], np.array([1, 2, 3, 4, 9], np.uint32))
    assert found.tolist() == [True] * 4 + [False] and got["offset"][:4].tolist() == [10, 20, 30, 40]


def test_letters_whose_lower_case_is_several_stay_with_their_signs():
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(idstore.tokenizer_path())
    several = [chr(c) for c in range(0x20000) if not 0xD800 <= c < 0xE000 and len(chr(c).lower()) > 1]
    letters = [*several, *"ßŉΣſKÅǅẞ"]
    texts = [f"ab{c}{s}x {c}{s} {c}b{s}{s} AB{c} Ab{s}" for c in letters for s in "!\"#$%&'()*+,-./:;<=>?@[\\]^_`{|}~"]
    texts += ["BELEDİYESİ, ANKARA", "ANKARA BELEDİYESİ.", "İ.", "don't!! Don'T, x_y_, 3rd."]
    made = idstore.WordEncoder(idstore.tokenizer_path()).payloads(texts)
    want = [e.ids + [idstore.END_ID] for e in library.encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(p, idstore.WIDTH).tolist() for p in made] == want
