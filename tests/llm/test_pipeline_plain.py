"""The first four stages of the pipeline against plain Python, row by row."""

import math
import re
import zlib
from collections import Counter

import corpus_pipeline
import pytest
import regex
from pyspark.sql import functions as F
from test_secrets import slow_base
from test_simhash import slow_fingerprint, slow_groups

from tallyroom.llm import language, quality, queries, secrets
from tallyroom.llm.shared import stored

DATA = "/root/testdata/sf0.001"
STAGES = dict(corpus_pipeline.STAGES)


@pytest.fixture(scope="module")
def docs(spark):
    """The smallest table, and rows made from it: exact, near and repeated copies, secrets, odd and long texts."""
    own = spark.read.parquet(f"{DATA}/documents.parquet")
    texts = [r["text"] for r in own.where("length(text) > 600").orderBy("doc_id").limit(6).collect()]
    rows = [(90_000 + i, t, "en", "made", len(t)) for i, t in enumerate(texts)]
    rows += [(90_100 + i, t + " coda", "en", "made", len(t) + 5) for i, t in enumerate(texts)]
    rows += [(90_200, f"{texts[0]} password: hunter2hunter2 and {'0f' * 20}", None, None, None)] * 2
    rows += [(90_300, None, None, None, None), (90_301, "", "en", "s", 0), (90_302, "12 34", None, "s", 5),
             (None, texts[1], "en", "s", 1), (None, None, None, None, None), (90_303, (texts[2] + "\n") * 300, "en", "s", 1)]
    return stored(own.unionByName(spark.createDataFrame(rows, own.schema)))


def ids(rows):
    return Counter(r["doc_id"] for r in rows)


def plain_statistics(text):
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    lines, size, n = text.split("\n"), max(len(text), 1), max(len(words), 1)
    count = {name: len(regex.findall(pattern, text)) for name, pattern in {
        "symbols": quality.SYMBOLS, "capitals": r"\p{Lu}", "letters": r"\p{L}", "digits": r"\p{Nd}", "marks": "[.,;:!?]",
        "exclamations": "!"}.items()}
    # A word counts as stuttered once for each match of it and its copy, left to right.
    stutters, i = 0, 0
    while i + 1 < len(words):
        hit = words[i] == words[i + 1]
        stutters += hit
        i += 2 if hit else 1
    return {name: c / size for name, c in count.items()} | {
        "n_words": len(words), "word_length": sum(map(len, words)) / n, "distinct_words": len(set(words)) / n,
        "stutter": stutters / n, "line_words": len(words) / len(lines), "repeated_lines": 1 - len(set(lines)) / len(lines)}


def test_quality_stage(spark, docs):
    model = queries.quality_model(docs, spark.read.parquet(f"{DATA}/labels.parquet"))
    assert model.rules

    def score(text):
        values = plain_statistics(text)
        total = model.intercept + sum(r.weight for r in model.rules if all(
            (low is None or values[name] > low) and (high is None or values[name] <= high)
            for name, low, high in r.conditions))
        return 1 / (1 + math.exp(-total))

    expected = [r for r in docs.collect() if score(r["text"]) >= 0.3]
    assert 0 < len(expected) < docs.count()
    assert ids(STAGES["quality_rules"](spark, docs, DATA).collect()) == ids(expected)


def plain_buckets(text):
    data = (" " + re.sub(r"[\W\d_]+", " ", text.lower()) + " ").encode()
    for k in range(3):
        for i in range(len(data) - k):
            yield ((int.from_bytes(data[i:i + k + 1], "big") * 0x9E3779B1 + k * 0x5EBCA6B) % 2**32) >> 17


def test_language_stage(spark, docs):
    rows, counts = docs.collect(), {}
    for r in rows:
        fold = zlib.crc32(("" if r["doc_id"] is None else str(r["doc_id"])).encode()) % 3
        if fold != 1 and r["lang"] is not None and r["text"] is not None:
            counts.setdefault(r["lang"], Counter()).update(plain_buckets(r["text"]) if r["text"] else ())
    names = sorted(counts)
    code = language.codewords(len(names))
    totals = {n: sum(counts[n].values()) + 0.5 * language.BUCKETS for n in names}

    def share(name, bucket):
        return (counts[name][bucket] + 0.5) / totals[name]

    def log_odds(bucket, bit):
        on = [share(n, bucket) for n, c in zip(names, code[:, bit], strict=True) if c > 0]
        off = [share(n, bucket) for n, c in zip(names, code[:, bit], strict=True) if c < 0]
        return math.log(sum(on) / len(on)) - math.log(sum(off) / len(off))

    bits = range(code.shape[1])
    odds = [[log_odds(b, bit) for bit in bits] for b in range(language.BUCKETS)]
    weights = []
    for i, name in enumerate(names):
        clear = [max(code[i][bit] * sum(share(name, b) * odds[b][bit] for b in range(language.BUCKETS)), 1e-3) for bit in bits]
        weights.append([c / sum(clear) for c in clear])

    def stays(text):
        if text is None or not any(c.isalpha() for c in text):
            return False
        grams = Counter(plain_buckets(text))
        scale = math.sqrt(1 + sum(grams.values()))
        margin = [sum(n * odds[b][bit] for b, n in grams.items()) / scale for bit in bits]
        loss = [sum(w * math.log1p(math.exp(-abs(m * c))) + w * max(-m * c, 0) for w, m, c in zip(
            weights[i], margin, code[i], strict=True)) for i in range(len(names))]
        likely = sorted((math.exp(min(loss) - x) for x in loss), reverse=True)
        return (likely[0] - likely[1]) / sum(likely) >= 0.05

    expected = [r for r in rows if stays(r["text"])]
    assert 0 < len(expected) < len(rows)
    assert ids(STAGES["language_codes"](spark, docs, DATA).collect()) == ids(expected)


def test_near_duplicate_stage(spark, docs):
    rows = docs.collect()
    groups = {}
    for row, root in zip(rows, slow_groups([slow_fingerprint(re.sub(r"[\x09-\x0D]", " ", r["text"] or "")) for r in rows]), strict=True):
        groups.setdefault(root, []).append(row)
    expected = [min(g, key=lambda r: (r["doc_id"] is None, r["doc_id"] or 0)) for g in groups.values()]
    got = STAGES["simhash_groups"](spark, docs, DATA).collect()
    assert ids(got) == ids(expected) and len(got) < len(rows) - 10
    assert {r["doc_id"]: r["text"] for r in got} == {r["doc_id"]: r["text"] for r in expected}


def test_secret_stage(spark, docs):
    model = queries.secret_model(docs)
    side = len(secrets.ALPHABET) + 1

    def mean_ratio(token):
        codes = [secrets.ALPHABET.find(c) + 1 for c in token]
        steps = [model.ratios[a * side + b] for a, b in zip(codes, codes[1:], strict=False)]
        return sum(steps) / max(len(steps), 1)

    def safe(text):
        base = [(s, e) for s, _, e in slow_base(text)]
        for m in re.finditer(secrets.TOKEN, text):
            outside = not any(s < m.end() and m.start() < e for s, e in base)
            if outside and mean_ratio(m[0]) > model.threshold + 1e-4:
                base.append(m.span())
        out, at = "", 0
        for start, end in sorted(base):
            if start >= at:
                out += text[at:start] + "[SECRET]"
            at = max(at, end)
        return out + text[at:]

    key = F.struct("doc_id", "source")
    before = sorted((str(r[0]), r[1] and safe(r[1])) for r in docs.select(key, "text").collect())
    after = STAGES["markov_secrets"](spark, docs, DATA).select(key, "text", "n_chars").collect()
    assert sorted((str(r[0]), r[1]) for r in after) == before
    assert all(r[2] == (None if r[1] is None else len(r[1])) for r in after)
    assert sum("[SECRET]" in (r[1] or "") for r in after) >= 2


def test_stages_on_an_empty_table(spark, docs):
    none = docs.limit(0)
    for name in ("quality_rules", "language_codes", "simhash_groups", "markov_secrets", "nnls_packing"):
        assert STAGES[name](spark, none, DATA).isEmpty(), name
