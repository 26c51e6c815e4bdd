import itertools
import random

import numpy as np
import xxhash

from tallyroom.llm import simhash
from tallyroom.llm.shared import components


def slow_fingerprint(text):
    words = [w for w in (text or "").encode().lower().replace(b"\n", b" ").split(b" ") if w]
    grams = [b" ".join(words[i:i + 3]) for i in range(len(words) - 2)] if len(words) >= 3 else [b" ".join(words)] if words else []
    hashes = [xxhash.xxh64_intdigest(g, 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def slow_groups(marks):
    parent = list(range(len(marks)))

    def top(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i, j in itertools.combinations(range(len(marks)), 2):
        if (marks[i] ^ marks[j]).bit_count() <= 3:
            a, b = top(i), top(j)
            parent[max(a, b)] = min(a, b)
    return [top(i) for i in range(len(marks))]


def test_fingerprints():
    for text in [None, "", " \n", "One", "one two", "ONE two  three", "a b c a b c a b c", "É é x y", "x " * 100_000]:
        if text is None or len(text) < 1000:
            assert simhash.fingerprint(text) == slow_fingerprint(text)
    assert simhash.fingerprint("x " * 100_000) == xxhash.xxh64_intdigest("x x x", 42)


def test_trie_finds_all_pairs():
    pick = random.Random(2)
    centres = [pick.getrandbits(64) for _ in range(30)]
    values = {c ^ sum(1 << pick.randrange(64) for _ in range(pick.randrange(5))) & (2**64 - 1) for c in centres for _ in range(20)}
    own = np.array(sorted(values), np.uint64)
    expected = {(i, j) for i, j in itertools.combinations(range(len(own)), 2) if (int(own[i]) ^ int(own[j])).bit_count() <= 3}
    found = {(int(i), int(j)) for a, b in simhash.trie_links(own, 0, 3) for i, j in zip(a, b, strict=True)}
    assert found == expected
    led = {(i, j) for i, j in expected if int(own[i]) >> 48 == int(own[j]) >> 48}
    assert {(int(i), int(j)) for a, b in simhash.trie_links(own, 16, 3) for i, j in zip(a, b, strict=True)} == led


def test_components_of_a_long_chain(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, 205), (205, 103)]
    random.Random(1).shuffle(links)
    frame = spark.createDataFrame(links, "a long, b long")
    assert {tuple(r) for r in components(frame, "a", "b").collect()} == {(i, 0) for i in range(61)} | {(i, 100) for i in (100, 103, 205)}
    assert components(frame.limit(0), "a", "b").count() == 0


def test_groups_match_brute_force(spark):
    rows = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").select("doc_id", "text").collect()
    texts = sorted((r["doc_id"], r["text"]) for r in rows) + [(9001, None), (9002, ""), (9003, " \n "), (9004, "a b c"), (9004, "a b c")]
    frame = spark.createDataFrame(texts, "doc_id long, text string").selectExpr("*", "1 as fingerprint", "2 as component_id", "3 as root")
    marks = [slow_fingerprint(t) for _, t in texts]
    groups = slow_groups(marks)
    expected = sorted((d, f"{m:016x}", texts[g][0]) for (d, _), m, g in zip(texts, marks, groups, strict=True))
    assert sorted(tuple(r) for r in simhash.grouped(frame.repartition(3)).collect()) == expected
    one = simhash.one_of_each(frame)
    assert one.columns == frame.columns
    assert sorted(r["doc_id"] for r in one.collect()) == sorted({c for _, _, c in expected})


def test_null_ids_and_empty_tables(spark):
    frame = spark.createDataFrame([(None, "a b c"), (None, "a b c"), (7, "a b c"), (None, "x y z")], "doc_id long, text string")
    out = sorted((r["doc_id"] or 0, r["component_id"]) for r in simhash.grouped(frame).collect() if r["component_id"])
    assert out == [(0, 7), (0, 7), (7, 7)]
    assert sorted(str(r["doc_id"]) for r in simhash.one_of_each(frame).collect()) == ["7", "None"]
    assert simhash.grouped(frame.limit(0)).count() == 0
    assert simhash.one_of_each(frame.limit(0)).count() == 0
