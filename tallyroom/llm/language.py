"""Language identification by error-correcting output codes.

Every language has a codeword of bits. Each bit has a binary classifier over hashed
character n-grams (one to three letters), which predicts the bit from the average
log-odds of a text's n-grams among the languages with that bit set against the others.
Decoding weighs each bit's loss by how well that classifier separates the language and
takes the codeword with the least loss; a text whose two nearest codewords lie close
together is flagged as ambiguous. All labelled documents are counted; a language's
counts have a fixed size.
"""

import re
import sys
from collections.abc import Iterator
from dataclasses import dataclass
from itertools import product

import numpy as np
import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import DataFrame, functions as F

cloudpickle.register_pickle_by_value(sys.modules[__name__])

BUCKETS = 1 << 15
#: Bytes that are hashed at once.
BLOCK = 1 << 20
UNKNOWN = "und"
_NO_LETTER = re.compile(r"[\W\d_]+")


def has_letter(text: str | None) -> bool:
    return text is not None and any(map(str.isalpha, text))


def _normal(text: str) -> np.ndarray:
    """Lower-cased letters as UTF-8 bytes, everything else one space; spaces at both ends."""
    return np.frombuffer((" " + _NO_LETTER.sub(" ", text.lower()) + " ").encode(), np.uint8)


def gram_buckets(data: np.ndarray) -> np.ndarray:
    """Buckets of all one-, two- and three-byte grams."""
    one = data.astype(np.uint32)
    two = one[:-1] << 8 | one[1:]
    three = two[:-1] << 8 | one[2:]
    mixed = [(g * np.uint32(0x9E3779B1) + np.uint32(k * 0x5EBCA6B)) >> np.uint32(17)
             for k, g in enumerate((one, two, three))]
    return np.concatenate(mixed)


def _blocks(texts: list[str]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(text number, bytes) of each text, in pieces that overlap by two bytes, so every gram is seen."""
    for i, text in enumerate(texts):
        data = _normal(text)
        for start in range(0, max(len(data) - 2, 1), BLOCK):
            yield i, data[start:start + BLOCK + 2]


def codewords(count: int) -> np.ndarray:
    """Distinct rows of -1 and 1, one per language; for many languages far apart by construction.

    Up to 6 languages have the exhaustive code. Beyond that, the code has 15 * ceil(log2 n) bits,
    drawn once from a fixed seed; the best of some draws by its least distance is taken.
    """
    if count <= 1:
        return np.ones((count, 1), np.int8)
    if count <= 6:
        columns = [(1, *rest) for rest in product((-1, 1), repeat=count - 1) if -1 in rest]
        return np.array(columns, np.int8).T
    bits, random, best = 15 * int(np.ceil(np.log2(count))), np.random.default_rng(7), None
    for _ in range(40):
        code = random.choice(np.array([-1, 1], np.int8), (count, bits))
        code = code[:, np.abs(code.sum(axis=0)) < count]
        apart = (code[:, None, :] != code[None, :, :]).sum(axis=2) + np.eye(count, dtype=int) * bits
        if best is None or apart.min() > best[0]:
            best = (apart.min(), code)
    return best[1]


@dataclass(frozen=True)
class LanguageModel:
    languages: tuple[str, ...]
    code: np.ndarray  # language x bit
    odds: np.ndarray  # bucket x bit: log-odds that the bit is 1
    weights: np.ndarray  # language x bit, each row sums to 1

    def predict(self, texts: list) -> tuple[list[str], np.ndarray, np.ndarray]:
        """Language, score and ambiguity margin of each text."""
        lettered = np.array([has_letter(t) for t in texts], bool)
        count = len(texts)
        if not self.languages:
            return [UNKNOWN] * count, np.zeros(count), np.zeros(count)
        sums, grams = np.zeros((count, self.odds.shape[1])), np.ones(count)
        for i, data in _blocks([t if ok else "" for t, ok in zip(texts, lettered, strict=True)]):
            if lettered[i]:
                hits = np.bincount(gram_buckets(data), minlength=BUCKETS) if len(data) > 1 << 14 else None
                if hits is None:
                    buckets = gram_buckets(data)
                    sums[i] += self.odds[buckets].sum(axis=0)
                    grams[i] += len(buckets)
                else:
                    sums[i] += hits @ self.odds
                    grams[i] += hits.sum()
        # Evidence adds up with length, but less than in proportion: grams overlap.
        margins = sums / np.sqrt(grams)[:, None]
        loss = np.logaddexp(0, -margins[:, None, :] * self.code[None, :, :])
        total = (loss * self.weights[None, :, :]).sum(axis=2)
        best = total.argmin(axis=1)
        likely = np.exp(total.min(axis=1, keepdims=True) - total)
        likely /= likely.sum(axis=1, keepdims=True)
        score = likely[np.arange(count), best]
        second = np.sort(likely, axis=1)[:, -2] if len(self.languages) > 1 else np.zeros(count)
        names = [self.languages[b] if ok else UNKNOWN for b, ok in zip(best, lettered, strict=True)]
        return names, np.where(lettered, score, 0.0), np.where(lettered, score - second, 0.0)


def fit(documents: DataFrame, text: str = "text", language: str = "lang") -> LanguageModel:
    """Counts the n-grams of all documents with a language and a text; tasks send sums, Spark adds them up.

    What reaches the driver has BUCKETS numbers for each language. NULL languages are left out.
    """
    def count(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        sums: dict[str, np.ndarray] = {}
        for batch in batches:
            for lang, texts in batch.groupby("lang")["text"]:
                own = sums.setdefault(lang, np.zeros(BUCKETS, np.int64))
                for _, data in _blocks([t for t in texts if t]):
                    own += np.bincount(gram_buckets(data), minlength=BUCKETS)
        for lang, own in sums.items():
            there = np.flatnonzero(own)
            yield pd.DataFrame({"lang": lang, "bucket": there, "n": own[there]})

    rows = documents.select(F.col(language).cast("string").alias("lang"), F.col(text).alias("text")).where(
        "lang is not null and text is not null").mapInPandas(count, "lang string, bucket int, n long").groupBy(
        "lang", "bucket").agg(F.sum("n").alias("n")).toPandas()
    languages = tuple(sorted(rows["lang"].unique()))
    counts = np.zeros((len(languages), BUCKETS))
    counts[np.searchsorted(np.array(languages, object), rows["lang"]), rows["bucket"]] = rows["n"]
    return from_counts(languages, counts)


def from_counts(languages: tuple[str, ...], counts: np.ndarray) -> LanguageModel:
    code = codewords(len(languages))
    share = (counts + 0.5) / (counts + 0.5).sum(axis=1, keepdims=True) if len(languages) else counts
    odds = np.zeros((BUCKETS, code.shape[1]), np.float32)
    if len(languages) > 1:
        for bit in range(code.shape[1]):
            on = code[:, bit] > 0
            odds[:, bit] = np.log(share[on].mean(axis=0)) - np.log(share[~on].mean(axis=0))
    clear = np.maximum((share @ odds) * code, 1e-3) if len(languages) else np.zeros((0, code.shape[1]))
    return LanguageModel(languages, code, odds, clear / clear.sum(axis=1, keepdims=True) if len(clear) else clear)


def identified(documents: DataFrame, model: LanguageModel, text: str = "text", gap: float = 0.05, prefix: str = "") -> DataFrame:
    """Adds `lang_pred`, `score` and `ambiguous`, with `prefix` in front, for every whole text.

    NULL texts and texts without a letter are `und` with score 0 and are not ambiguous;
    with no learned language every text is. `ambiguous` marks texts whose two nearest
    codewords differ by less than `gap` in score.
    """
    shared = documents.sparkSession.sparkContext.broadcast(model)  # BUCKETS x bits numbers

    @F.pandas_udf("lang string, score double, ambiguous boolean")
    def judge(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            names, score, apart = shared.value.predict(list(batch))
            yield pd.DataFrame({"lang": names, "score": score, "ambiguous": [
                n != UNKNOWN and a < gap for n, a in zip(names, apart, strict=True)]})

    judged = documents.withColumn("__judged", judge(F.col(text)))
    return judged.withColumns({prefix + new: F.col(f"__judged.{old}") for new, old in (
        ("lang_pred", "lang"), ("score", "score"), ("ambiguous", "ambiguous"))}).drop("__judged")
