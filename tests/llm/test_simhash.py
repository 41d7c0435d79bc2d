import random
import re
import tracemalloc

import numpy as np
import pandas as pd
import pytest
import xxhash

from haulmart.llm import graph, simhash


def brute_print(text):
    low = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", low)
    rows = [" ".join(words[k : k + 4]) for k in range(len(words) - 3)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64_intdigest(r.encode(), 42) for r in rows]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius=4):
    """Least index reachable, by comparing all pairs."""
    out = list(range(len(prints)))
    changed = True
    while changed:
        changed = False
        for i, a in enumerate(prints):
            for j, b in enumerate(prints):
                if (a ^ b).bit_count() <= radius and out[j] < out[i]:
                    out[i], changed = out[j], True
    return out


@pytest.mark.parametrize("text", [
    None, "", "  \t", "One", "a b c", "A b C d", "a b c d e f g a b c d", "ÀÉ É x y z w é",
    "word " * 500, " ".join(map(str, range(70_000))),
])
def test_fingerprint_equals_a_plain_one(text):
    assert simhash.fingerprint(text) == brute_print(text)


@pytest.mark.parametrize("at_once", [3000, 4_000_000])
def test_links_connect_what_all_pairs_connect(spark, at_once):
    draw = random.Random(5)
    prints = [0, (1 << 64) - 1, 0b1111, 0b11111 << 59]
    for _ in range(40):
        base = draw.getrandbits(64)
        prints.append(base)
        for _ in range(draw.randrange(6)):
            for bit in draw.sample(range(64), draw.choice([1, 2, 3, 4, 4, 5, 8])):
                base ^= 1 << bit
            prints.append(base)
    prints = sorted(set(prints))
    frame = spark.createDataFrame([(simhash._signed(p),) for p in prints], "print long")
    pairs = simhash.links(frame, at_once=at_once).collect()
    assert all(((r.a ^ r.b) & (1 << 64) - 1).bit_count() <= 4 for r in pairs)
    parent = {p: p for p in prints}

    def root(p):
        while parent[p] != p:
            p = parent[p]
        return p

    for r in pairs:
        a, b = (root(x & (1 << 64) - 1) for x in (r.a, r.b))
        parent[max(a, b)] = min(a, b)
    assert [root(p) for p in prints] == [prints[i] for i in brute_components(prints)]


def test_components_of_chains_stars_and_loops(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, j) for j in range(101, 180)] + [(200, 200), (201, 202), (202, 203), (203, 201)]
    frame = spark.createDataFrame(edges, "a long, b long").repartition(4)
    got = {r.node: r.root for r in graph.components(frame).collect()}
    want = {i: 0 for i in range(61)} | {i: 100 for i in range(100, 180)} | {201: 201, 202: 201, 203: 201}
    assert got == want


def test_documents_and_survivors(docs_of, odd_rows):
    rng = random.Random(1)
    base = [f"w{rng.randrange(900)}" for _ in range(300)]
    rows = [(i, " ".join(base[:-i] if i else base), "en", "s") for i in (0, 1, 2)]
    rows += [(50 + i, " ".join(f"v{rng.randrange(900)}" for _ in range(200)), "en", "s") for i in range(20)]
    rows += [(90, rows[5][1], "en", "s")]
    docs = docs_of(rows)
    texts = [r[1] for r in rows]
    roots = brute_components([brute_print(t) for t in texts])
    least = {}
    for r, k in zip(rows, roots):
        least[k] = min(least.get(k, r[0]), r[0])
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.near_duplicates(docs).collect()}
    assert got == {r[0]: (f"{brute_print(r[1]):016x}", least[k]) for r, k in zip(rows, roots)}
    assert {r.doc_id for r in simhash.keep_one(docs).collect()} == set(least.values())


@pytest.mark.parametrize("clashing", [False, True])
def test_odd_rows(docs_of, odd_rows, clashing):
    docs = docs_of(odd_rows, clashing)
    got = simhash.near_duplicates(docs).collect()
    assert len(got) == len(odd_rows)
    assert {r.component_id for r in got if r.fingerprint == "0" * 16} == {1}
    kept = simhash.keep_one(docs)
    assert kept.columns == docs.columns
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == [-3, 1, 4, 5, 6, 7, 8]


def test_empty_table(docs_of):
    empty = docs_of([(1, "x", "en", "s")]).limit(0)
    assert simhash.near_duplicates(empty).count() == 0 and simhash.keep_one(empty).count() == 0


def test_a_group_of_a_large_table_unfolds_in_little_memory():
    rng = np.random.default_rng(7)
    one = rng.integers(0, 1 << 57, 800, np.uint64)
    two = one ^ np.uint64(1) << rng.integers(0, 57, 800, np.uint64)
    group = pd.DataFrame({"print": np.concatenate([one, two]).view(np.int64), "left": 2})
    tracemalloc.start()
    found = simhash._meet(group, 57, simhash.RADIUS, simhash.AT_ONCE)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(found) == 800 and most < 50e6
