import hashlib
import zlib
from collections import defaultdict

import pytest
from conftest import DATA
from pyspark.sql import functions as F

from tallyroom.llm import manifest, queries


def h(text):
    return hashlib.sha256(text.encode()).hexdigest()


def field(value):
    if value is None:
        return "-"
    text = str(value)
    return f"{len(text.encode())}:{text}"


def levels(digests):
    out = [digests]
    while len(out[-1]) > 1:
        out.append([h("".join(out[-1][i:i + 3])) for i in range(0, len(out[-1]), 3)])
    return out


def way(tree, at):
    """(left siblings, right siblings) of a node, level by level."""
    out = []
    for nodes in tree[:-1]:
        run, slot = nodes[at // 3 * 3:at // 3 * 3 + 3], at % 3
        out.append((run[:slot], run[slot + 1:]))
        at //= 3
    return out


def brute(rows):
    """rows: (doc_id, source, lang, n_chars, text)."""
    groups = defaultdict(list)
    for row in rows:
        groups[row[1]].append((row[0] is not None, row[0] or 0, h("".join(map(field, row))), row))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = {}
    for name in names:
        groups[name].sort(key=lambda x: x[:3])
        trees[name] = levels([x[2] for x in groups[name]])
    top = levels([trees[n][-1][0] for n in names])
    out = []
    for k, name in enumerate(names):
        for at, (_, _, leaf, row) in enumerate(groups[name]):
            steps = way(trees[name], at) + way(top, k)
            node, text = leaf, row[4]
            if row[0] is not None and zlib.crc32(str(row[0]).encode()) % 2 == 0:
                node = h("".join(map(field, (*row[:4], None if text is None else text.replace("\n", "")))))
            for left, right in steps:
                node = h("".join([*left, node, *right]))
            proof = h("".join("".join(left + right) for left, right in steps))
            out.append((row[0], leaf, trees[name][-1][0], top[-1][0], proof, node, node == top[-1][0]))
    return sorted(out, key=str)


SCHEMA = "doc_id long, source string, lang string, n_chars long, text string"


def run(frame):
    tampered = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 2 == 0
    got = manifest.manifest(frame, queries.MANIFEST_FIELDS, changed={"text": F.replace("text", F.lit("\n"), F.lit(""))}, where=tampered)
    return sorted(map(tuple, got.collect()), key=str)


def test_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{DATA}/documents.parquet").select(*SCHEMA.replace(",", "").split()[::2]).collect()]
    got = sorted(map(tuple, queries.QUERIES["op12_merkle_manifest"](spark, DATA).collect()), key=str)
    assert got == brute(rows)
    assert {r[-1] for r in got} == {True, False}


@pytest.mark.parametrize("size", [1, 2, 3, 4, 9, 10, 243, 244, 245, 730])
def test_groups_of_any_size(spark, size):
    rows = [(i, "big", "en", i, f"a\n{i}") for i in range(size)] + [(i, f"s{i}", None, None, "x") for i in range(7)] + [(3, None, "", 0, None)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_many_groups(spark):
    rows = [(i, f"s{i:04d}", "en", 1, "a\nb") for i in range(600)]
    assert run(spark.createDataFrame(rows, SCHEMA)) == brute(rows)


def test_hard_rows(spark):
    rows = [(None, "a", None, None, None), (None, "a", "en", 1, "x\n"), (1, "", "en", 2, "é\n\U0001f642"), (1, "", "en", 2, "é\n\U0001f642"),
            (2, None, None, None, ""), (2**62 + 1, "é", "de", -1, "\n\n"), (5, "z", "12:", 3, "y" * 300_000), (6, "Z", "-", 3, "-")]
    frame = spark.createDataFrame(rows, SCHEMA).selectExpr("*", "1 as g", "2 as place", "3 as leaf", "4 as size")
    assert run(frame) == brute(rows)
    assert run(frame.limit(0)) == []


def test_proofs_fold_to_the_root(spark):
    rows = [(i, "s", "en", 1, f"t{i}") for i in range(20)]
    for r in manifest.manifest(spark.createDataFrame(rows, SCHEMA), queries.MANIFEST_FIELDS, proofs=True).collect():
        assert h(r["proof"]) == r["proof_sha256"] and r["verified"] and len(r["proof"]) % 64 == 0


def test_parents_resume_the_state_of_a_slot():
    children = [h(x) for x in "abc"]
    for count in (1, 2, 3):
        parent = manifest.Parent(children[:count])
        assert parent.digest == h("".join(children[:count])) and len(parent.states) == count
        for slot in range(count):
            other = children[:count]
            other[slot] = h("new")
            assert parent.folded(slot, h("new")) == h("".join(other))
            left, right = parent.siblings(slot)
            assert manifest.Step(left, right).folded(h("new")) == h("".join(other))
