"""Secret scans: fixed patterns, and two Markov models of characters compared by log-likelihood ratio.

One model learns random strings, the other ordinary identifiers, both from labelled
samples: transitions between neighbouring characters are counted by Spark, and their
log-ratios become one array literal. A long token is a secret if its mean log-ratio per
transition exceeds a threshold that is set on the samples. Everything here is DataFrame
functions; positions are code points.
"""

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.binding import let

# The kinds in order, their patterns and least lengths (of the group named).
ASSIGN = r"""(?i:(password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]{16,}"
HEX = r"[0-9a-f]{24,}"
ASSIGN_LEAST = 6
KINDS = ("assign", "access", "hex", "markov")
TOKEN = r"(?<![A-Za-z0-9+/_=-])[A-Za-z0-9+/_=-]{20,}"
ALPHABET = "abcdefghijklmnopqrstuvwxyzABCDEFGHIJKLMNOPQRSTUVWXYZ0123456789+/_=-"

_SIDE = len(ALPHABET) + 1  # 0 stands for any other character
_STEP = 256


def before(values: Column) -> Column:
    """For each element the sum of all earlier ones; sums of blocks keep long arrays cheap."""
    def total(v: Column, start: Column, count: Column) -> Column:
        return F.aggregate(F.slice(v, start + 1, count), F.lit(0), lambda a, x: a + x)

    def sums(v: Column) -> Column:
        blocks = F.transform(F.sequence(F.lit(0), F.floor(F.size(v) / _STEP).cast("int")), lambda b: total(v, F.lit(0), b * _STEP))
        return let(blocks, lambda s: F.transform(v, lambda _, i: F.get(s, F.floor(i / _STEP).cast("int")) + total(
            v, i - i % _STEP, i % _STEP)))

    return let(values, sums)


def matches(text: Column, pattern: str, kind: str, least: int = 0, group: int = 0) -> Column:
    """Spans (start, order, end, kind) of the leftmost matches whose `group` has at least `least` characters."""
    order = KINDS.index(kind)

    def spans(found: Column) -> Column:
        gaps = F.transform(F.slice(F.split(text, pattern), 1, F.size(found)), F.length)
        sizes = F.transform(found, F.length)

        def place(g: Column, s: Column) -> Column:
            steps = F.zip_with(g, s, lambda a, b: a + b)
            return F.transform(before(steps), lambda at, i: F.struct(
                (at + F.get(g, i)).alias("start"), F.lit(order).alias("order"),
                (at + F.get(g, i) + F.get(s, i)).alias("end"), F.lit(kind).alias("kind")))

        return let(gaps, lambda g: let(sizes, lambda s: place(g, s)))

    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    placed = let(found, spans)
    if group:
        values = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
        placed = let(values, lambda v: F.filter(placed, lambda _, i: F.length(F.get(v, i)) >= least))
    return placed


def _none() -> Column:
    return F.array().cast("array<struct<start:int,order:int,end:int,kind:string>>")


def base_spans(text: Column) -> dict[str, Column]:
    """The spans of the fixed patterns by kind. Texts without a trace of a kind skip its search."""
    return {
        "assign": F.when(text.rlike("(?i:passw|secret|token|api_?key)"), matches(text, ASSIGN, "assign", ASSIGN_LEAST, 2)).otherwise(_none()),
        "access": F.when(text.contains("AKIA"), matches(text, ACCESS, "access")).otherwise(_none()),
        "hex": F.when(text.rlike(HEX), matches(text, HEX, "hex")).otherwise(_none()),
    }


def words_outside(text: Column, pattern: str, spans: Column) -> Column:
    """Matches of `pattern` that overlap none of the spans. Only texts with spans need the places of their matches."""
    placed = F.filter(matches(text, pattern, "markov"), lambda w: ~F.exists(
        spans, lambda b: (b["start"] < w["end"]) & (w["start"] < b["end"])))
    outside = F.transform(placed, lambda w: F.substring(text, w["start"] + 1, w["end"] - w["start"]))
    return F.when(F.size(spans) == 0, F.regexp_extract_all(text, F.lit(pattern), F.lit(0))).otherwise(outside)


@dataclass(frozen=True)
class MarkovPair:
    """Log-ratios (random against identifier) of all transitions, row by row, and the threshold of their mean."""

    ratios: tuple[float, ...]
    threshold: float

    def mean_ratio(self, token: Column) -> Column:
        table = F.split(F.lit(",".join(f"{r:.5f}" for r in self.ratios)), ",").cast("array<double>")
        codes = F.transform(F.filter(F.split(token, ""), lambda c: c != ""), _code)

        def mean(c: Column) -> Column:
            steps = F.transform(F.sequence(F.lit(1), F.size(c) - 1), lambda i: F.get(table, F.get(c, i - 1) * _SIDE + F.get(c, i)))
            return F.when(F.size(c) < 2, F.lit(0.0)).otherwise(
                F.aggregate(steps, F.lit(0.0), lambda a, x: a + x) / (F.size(c) - 1))

        return let(codes, mean)


def _code(character: Column) -> Column:
    return F.instr(F.lit(ALPHABET), character)


def train(samples: DataFrame, token: str = "token", secret: str = "secret", smoothing: float = 0.5,
          keep: float = 0.999) -> MarkovPair:
    """Counts transitions of both classes; the threshold lets at least `keep` of the identifiers pass unmarked.

    Tokens shorter than two characters and NULLs are left out. Without samples of a class its
    transitions are uniform. The driver sees one number per transition and class.
    """
    rows = samples.select(F.col(token).alias("token"), F.col(secret).cast("boolean").alias("secret")).where(
        "token is not null and secret is not null and length(token) > 1")
    codes = rows.withColumn("codes", F.transform(F.filter(F.split("token", ""), lambda c: c != ""), _code))
    steps = codes.select("secret", F.explode(F.transform(
        F.sequence(F.lit(1), F.size("codes") - 1),
        lambda i: F.get("codes", i - 1) * _SIDE + F.get("codes", i))).alias("step"))
    counts = {True: [0] * _SIDE**2, False: [0] * _SIDE**2}
    for row in steps.groupBy("secret", "step").count().collect():  # at most 2 * 68 * 68 rows
        counts[row["secret"]][row["step"]] = row["count"]

    def log_shares(own: list[int]) -> list[float]:
        out = []
        for i in range(_SIDE):
            line = own[i * _SIDE:(i + 1) * _SIDE]
            out += [math.log((n + smoothing) / (sum(line) + smoothing * _SIDE)) for n in line]
        return out

    ratios = tuple(a - b for a, b in zip(log_shares(counts[True]), log_shares(counts[False]), strict=True))
    pair = MarkovPair(ratios, 0.0)
    limit = rows.where("not secret").select(F.percentile_approx(pair.mean_ratio(F.col("token")), keep, 1000)).first()[0]
    return MarkovPair(ratios, max(limit or 0.0, 0.0))


def marked(documents: DataFrame, model: MarkovPair, text: str = "text") -> DataFrame:
    """Adds `n_assign`, `n_access`, `n_hex` and `found`: all spans by start, then kind, as (start, end, kind).

    The model's spans are tokens outside the fixed patterns' spans. NULL and empty texts have
    none; repeated rows are each searched. `base` holds the spans of the fixed patterns alone.
    """
    whole = F.coalesce(F.col(text), F.lit(""))
    tokens = F.when(whole.rlike(TOKEN), matches(whole, TOKEN, "markov")).otherwise(_none())
    own = documents.withColumns({f"__{k}": spans for k, spans in base_spans(whole).items()}).withColumn("__tokens", tokens)
    own = own.withColumns({f"n_{k}": F.size(f"__{k}").cast("long") for k in KINDS[:3]} | {
        "base": F.sort_array(F.concat("__assign", "__access", "__hex"))})
    random = F.filter("__tokens", lambda t: ~F.exists("base", lambda b: (b["start"] < t["end"]) & (t["start"] < b["end"])) & (
        model.mean_ratio(F.substring(whole, t["start"] + 1, t["end"] - t["start"])) > model.threshold))
    added = F.when(F.size("__tokens") == 0, F.col("base")).otherwise(F.sort_array(F.concat("base", random)))
    return own.withColumn("found", added).drop("__assign", "__access", "__hex", "__tokens")


def span_text(spans: Column) -> Column:
    """kind:start:end, joined by commas."""
    return F.array_join(F.transform(spans, lambda s: F.concat_ws(":", s["kind"], s["start"], s["end"])), ",")


def without_secrets(documents: DataFrame, model: MarkovPair, text: str = "text", sign: str = "[SECRET]") -> DataFrame:
    """The documents with every span (overlapping ones together) replaced by `sign`; columns stay as they are."""
    columns = documents.columns
    found = marked(documents.withColumn("__text", F.col(text)), model, "__text")

    def step(done: Column, span: Column) -> Column:
        return F.struct(
            F.when(span["start"] < done["at"], done["out"]).otherwise(F.concat(
                done["out"], F.substring("__text", done["at"] + 1, span["start"] - done["at"]), F.lit(sign))).alias("out"),
            F.greatest(done["at"], span["end"]).alias("at"))

    start = F.struct(F.lit("").alias("out"), F.lit(0).alias("at"))
    rest = F.aggregate("found", start, step, lambda d: F.concat(d["out"], F.substring("__text", d["at"] + 1, F.length("__text"))))
    safe = F.when(F.size("found") == 0, F.col("__text")).otherwise(rest)
    return found.withColumn("__safe", safe).select(*[
        F.col("__safe").alias(c) if c == text else F.col(f"`{c}`") for c in columns])
