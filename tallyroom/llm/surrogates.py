"""Personal data replaced by keyed surrogates of the same type and format.

An entity has a kind and a canonical form (a phone number's digits, an email in lower
case, one part of a name). Its surrogate is a keyed permutation of all forms of the
same shape: digits stay digits, vowels vowels, capitals capitals; network addresses stay
addresses, card numbers keep their checksum's state; a given name becomes one of the
same gender and script. A permutation keeps distinct entities distinct and maps every
mention of an entity alike, in all documents. What a permutation cannot rule out is
checked over the corpus: a surrogate must not be an entity that occurs there, and
entities that had to take another one must not meet. Those are a table of exceptions, which
Spark joins to the texts that mention them.
"""

import hashlib
import re
import sys
import unicodedata
from collections.abc import Iterator
from math import isqrt

import pandas as pd
from pyspark import cloudpickle
from pyspark.sql import Column, DataFrame, functions as F

from .shared import stored

cloudpickle.register_pickle_by_value(sys.modules[__name__])

# Given names by script and gender, and titles.
GIVEN = {
    ("latin", "f"): "Anna Maria Mary Emma Laura Julia Sarah Alice Helen Clara Marie Sophie Camille Louise Carmen Lucia "
                    "Elena Ingrid Greta Heidi".split(),
    ("latin", "m"): "John James Peter Paul Thomas Michael David Robert William George Pierre Louis Jean Hans Klaus "
                    "Karl Carlos Miguel Pablo Diego".split(),
    ("cyrillic", "f"): "Анна Мария Ольга Елена Наталья Татьяна Ирина Светлана".split(),
    ("cyrillic", "m"): "Иван Сергей Андрей Дмитрий Алексей Николай Михаил Павел".split(),
}
TITLES = {"Mr": "m", "Mrs": "f", "Ms": "f", "Miss": "f", "Dr": "", "Herr": "m", "Frau": "f", "Monsieur": "m",
          "Madame": "f", "Señor": "m", "Señora": "f", "Господин": "m", "Госпожа": "f"}
#: Address ranges with a use of their own (start, prefix length); all other addresses are public.
NETWORKS = (("0.0.0.0", 8), ("10.0.0.0", 8), ("100.64.0.0", 10), ("127.0.0.0", 8), ("169.254.0.0", 16), ("172.16.0.0", 12),
            ("192.0.2.0", 24), ("192.168.0.0", 16), ("198.18.0.0", 15), ("198.51.100.0", 24), ("203.0.113.0", 24),
            ("224.0.0.0", 4), ("240.0.0.0", 4))
CLASSES = ("0123456789", "aeiou", "bcdfghjklmnpqrstvwxyz", "аеиоуыэюя", "бвгджзйклмнпрстфхцчшщ", "àáâäèéêëìíîïòóôöùúûü",
           "ãåæõøýÿ", "çðñþ", "ъьё")
#: Attempts at a surrogate, after which clashes are an error. Every eighth makes the form longer by a character.
LAST_ATTEMPT, GROWS = 64, 8

_OF = {c: group for group in CLASSES for c in group}
_ALPHABETS = dict(_OF)
_GENDER = {name: (script, gender) for (script, gender), names in GIVEN.items() for name in names}
#: Canonical forms of the given names of the lists.
LISTED = sorted(f"{gender}:{name.lower()}" for name, (_, gender) in _GENDER.items())
_NAMES = "|".join(sorted(_GENDER, key=len, reverse=True))
_TITLES = "|".join(sorted(TITLES, key=len, reverse=True))
_CAPITAL = r"[A-ZÀ-ÖØ-ÞА-Я][\w'’-]*[^\W\d_]"
_OCTET = r"(?:25[0-5]|2[0-4]\d|1\d\d|[1-9]?\d)"
_NUMBERS = re.compile("|".join((
    r"(?P<email>(?<![\w.%+-])[\w.%+-]++@[\w-]+(?:\.[\w-]+)+)",
    rf"(?P<ip>(?<![\d.])(?:{_OCTET}\.){{3}}{_OCTET}(?!\d|\.\d))",
    r"(?P<iban>\b[A-Z]{2}[0-9]{2}(?: ?[A-Z0-9]{4}){3,7}(?: ?[A-Z0-9]{1,3})?\b)",
    r"(?P<phone>\+[0-9]{1,3}[ .-]?\(?[0-9]{1,4}\)?(?:[ .-]?[0-9]{2,4}){2,4}(?![0-9])"
    r"|\([0-9]{2,4}\)[ .-]?[0-9]{3,4}[ .-]?[0-9]{3,4}(?![0-9])|(?<![0-9])[0-9]{3}[ .-][0-9]{3}[ .-][0-9]{4}(?![0-9]))",
    r"(?P<card>(?<![0-9])[0-9](?:[ -]?[0-9]){12,18}(?![0-9]))",
    r"(?P<ssn>(?<![0-9-])[0-9]{3}-[0-9]{2}-[0-9]{4}(?![0-9-]))",
)))
_PERSON = re.compile(rf"\b(?:(?P<title>{_TITLES})\.? (?P<titled>{_CAPITAL}(?: {_CAPITAL}){{0,2}})|(?P<named>(?:{_NAMES})(?: {_CAPITAL}){{1,2}}))")
#: What a text must hold to be looked at in Python at all.
TRACE = rf"[0-9@]|\b({_TITLES}|{_NAMES})\b"


def _number(key: bytes, *what) -> int:
    return int.from_bytes(hashlib.blake2b("\0".join(map(str, what)).encode(), key=key, digest_size=32).digest(), "big")


def permuted(value: int, size: int, key: bytes, *tweak) -> int:
    """A keyed permutation of 0 to size - 1: an unbalanced Feistel network, walked until it falls inside."""
    if size < 2:
        return value
    a = isqrt(size - 1) + 1
    b = -(-size // a)
    while True:
        left, right = value % a, value // a
        for turn in range(4):
            left = (left + _number(key, *tweak, size, turn, "l", right)) % a
            right = (right + _number(key, *tweak, size, turn, "r", left)) % b
        value = right * a + left
        if value < size:
            return value


def _alphabet(c: str) -> str:
    """The characters that may stand for this one: its class, or letters or digits alike in its 256 code points, or none."""
    def like(x: str) -> tuple:
        return unicodedata.category(x), x.lower() == x, len(x.upper()) == 1 and x.upper().lower() == x

    if c not in _ALPHABETS:
        block = map(chr, range(ord(c) & ~255, (ord(c) | 255) + 1))
        _ALPHABETS[c] = "".join(x for x in block if x not in _OF and x.isalnum() and like(x) == like(c)) if c.isalnum() else ""
    return _ALPHABETS[c]


def _shaped(form: str, key: bytes, *tweak) -> str:
    """A permutation among all forms with the same alphabets of letters and digits; other characters stay."""
    value, size, shape = 0, 1, []
    groups = [_alphabet(c) for c in form]
    for c, group in zip(form, groups, strict=True):
        if group:
            value, size = value * len(group) + group.index(c), size * len(group)
        shape.append(str(CLASSES.index(group)) if group in CLASSES else group[:1] or c)
    value, out = permuted(value, size, key, *tweak, "".join(shape)), []
    for c, group in zip(reversed(form), reversed(groups), strict=True):
        if group:
            value, place = divmod(value, len(group))
            c = group[place]
        out.append(c)
    return "".join(reversed(out))


def luhn_digit(digits: str) -> int:
    total = sum(sum(divmod(int(d) * (2 if i % 2 == 0 else 1), 10)) for i, d in enumerate(reversed(digits)))
    return -total % 10


def _address(form: str) -> int:
    value = 0
    for part in form.split("."):
        value = value << 8 | int(part)
    return value


_RANGES = [(_address(start), 1 << 32 - length) for start, length in NETWORKS]


def _range(value: int) -> tuple[int, int] | None:
    return next(((start, size) for start, size in _RANGES if start <= value < start + size), None)


def _other_address(form: str, key: bytes, attempt: int) -> str:
    """An address of the same range; public ones stay public. Late attempts take a public one, as small ranges may be full."""
    value, own = _address(form), _range(_address(form))
    if own and attempt < GROWS:
        value = own[0] + permuted(value - own[0], own[1], key, "ip", attempt, own[0])
    else:  # the permutation is walked until it leaves the ranges, so different addresses stay different
        value = permuted(value, 1 << 32, key, "ip", attempt)
        while _range(value):
            value = permuted(value, 1 << 32, key, "ip", attempt)
    return ".".join(str(value >> s & 255) for s in (24, 16, 8, 0))


def iban_digits(country: str, body: str) -> int:
    """The check digits of an account number, 2 to 98."""
    return 98 - int("".join(str(int(c, 36)) for c in body + country + "00")) % 97


def _other_account(form: str, key: bytes, *tweak) -> str:
    """Another account of the same country; check digits that hold do so again, and others are off by as much."""
    country, digits, body = form[:2], int(form[2:4]), form[4:]
    new = _shaped(body, key, *tweak, country)
    if 2 <= digits <= 98:
        digits = (digits - iban_digits(country, body) + iban_digits(country, new) - 2) % 97 + 2
    return f"{country}{digits:02d}{new}"


def surrogate(kind: str, form: str, key: bytes, attempt: int = 0) -> str:
    """The surrogate of a canonical form; `attempt` picks another permutation. Late attempts grow by a character."""
    tweak = (kind, attempt)
    if attempt >= GROWS and kind != "ip" and not (kind == "given" and form in LISTED):
        body, at, domain = form.partition("@") if kind == "email" else (form, "", "")
        form = body + "a0"[body[-1:].isdigit()] * (attempt // GROWS) + at + domain
    if kind == "ip":
        return _other_address(form, key, attempt)
    if kind == "iban":
        return _other_account(form, key, *tweak)
    if kind == "card":
        body = _shaped(form[:-1], key, *tweak)
        return body + str((luhn_digit(body) + int(form[-1]) - luhn_digit(form[:-1])) % 10)
    if kind == "email":
        local, _, domain = form.partition("@")
        names, _, top = domain.rpartition(".")
        return f"{_shaped(local, key, *tweak)}@{_shaped(names, key, 'domain', 0)}.{top}"
    if kind == "given":
        gender, _, name = form.partition(":")
        script = "cyrillic" if re.search("[а-я]", name) else "latin"
        names = [n.lower() for n in GIVEN.get((script, gender), ())]
        if name in names:  # one more step, so that a name never maps to itself
            order = sorted(names, key=lambda n: _number(key, "given", attempt // max(1, len(names) - 1), n))
            return f"{gender}:{order[(order.index(name) + 1 + attempt % (len(names) - 1)) % len(names)]}"
        return f"{gender}:{_shaped(name, key, *tweak)}"
    return _shaped(form, key, *tweak)


def _dressed(form: str, mention: str) -> str:
    """The surrogate with the mention's punctuation and capitals; what is longer goes at the end."""
    letters, out = list(form), []
    for c in mention:
        if not c.isalnum():
            out.append(c)
            if letters and not letters[0].isalnum():
                letters.pop(0)
        elif letters:
            new = letters.pop(0)
            out.append(new.upper() if c.isupper() else new)
    return "".join(out + letters)


def _canonical(kind: str, mention: str) -> str:
    if kind in ("phone", "card", "ssn"):
        return re.sub(r"[^0-9]", "", mention)
    return re.sub(r" ", "", mention.lower()) if kind == "iban" else mention.lower()


def entities(text: str) -> list[tuple[int, int, str, str]]:
    """(start, end, kind, canonical form) in order, without overlaps.

    A person's parts are entities of their own; later mentions of a family name alone, or of
    an untitled given name, in the same text are the same entities.
    """
    found = [(m.start(), m.end(), m.lastgroup, _canonical(m.lastgroup, m[0])) for m in _NUMBERS.finditer(text)]
    parts: dict[str, tuple[str, str]] = {}
    for m in _PERSON.finditer(text):
        group = "titled" if m["titled"] else "named"
        names = m[group].split(" ")
        gender = TITLES.get(m["title"] or "", "")
        family = names[-1] if len(names) > 1 or names[0] not in _GENDER else None
        for name in names[:-1] if family else names:
            parts.setdefault(name, ("given", f"{_GENDER.get(name, ('', gender))[1]}:{name.lower()}"))
        if family:
            parts.setdefault(family, ("family", family.lower()))
    if parts:
        again = re.compile(rf"\b(?:{'|'.join(map(re.escape, sorted(parts, key=len, reverse=True)))})\b")
        found += [(m.start(), m.end(), *parts[m[0]]) for m in again.finditer(text)]
    out: list[tuple[int, int, str, str]] = []
    for entity in sorted(found, key=lambda e: (e[0], -e[1])):
        if not out or entity[0] >= out[-1][1]:
            out.append(entity)
    return out


def replaced(text: str, key: bytes, attempts: dict[tuple[str, str], int]) -> tuple[str, int]:
    """The text with its surrogates, and how many mentions were replaced."""
    out, at, found = [], 0, entities(text)
    for start, end, kind, form in found:
        new = surrogate(kind, form, key, attempts.get((kind, form), 0))
        mention = text[start:end]
        if kind == "email":  # what is longer goes at the end of the name, not of the domain
            new = "@".join(map(_dressed, new.split("@"), mention.split("@")))
        elif kind != "ip":
            new = _dressed(new.partition(":")[2] if kind == "given" else new, mention)
        out += [text[at:start], new]
        at = end
    return "".join([*out, text[at:]]), len(found)


def _suspect(text: Column) -> Column:
    return F.when(text.rlike(TRACE), text)


def _mentions(documents: DataFrame, text: str) -> DataFrame:
    """(mark, kind, form): the entities of each text, which is known by a hash. Texts of one hash share their entities."""
    def find(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for batch in batches:
            own = {(mark, kind, form) for mark, t in zip(batch["mark"], batch["text"], strict=True) for _, _, kind, form in entities(t)}
            yield pd.DataFrame(sorted(own), columns=["mark", "kind", "form"])

    suspects = documents.select(F.xxhash64(text).alias("mark"), _suspect(F.col(text)).alias("text")).where("text is not null")
    return stored(suspects.mapInPandas(find, "mark long, kind string, form string"))


def exceptions(documents: DataFrame, key: bytes, text: str = "text") -> DataFrame:
    """Entities (kind, form) whose first surrogate occurs as an entity of the corpus, or meets another's; with their attempt.

    Only distinct entities are shuffled, and the driver sees counts. Clashes left after
    LAST_ATTEMPT attempts raise an error.
    """
    return _exceptions(_mentions(documents, text), key)


def _exceptions(mentions: DataFrame, key: bytes) -> DataFrame:
    @F.pandas_udf("string")
    def new_form(kind: pd.Series, form: pd.Series, attempt: pd.Series) -> pd.Series:
        return pd.Series([surrogate(k, f, key, a) for k, f, a in zip(kind, form, attempt, strict=True)], dtype=object)

    known = stored(mentions.select("kind", "form").distinct())
    # The short lists of given names may be used up: their surrogates are distinct by the list's order and may occur
    # elsewhere. Other given names yield to them. Names are compared without the gender in front of them.
    listed = (F.col("kind") == "given") & F.col("form").isin(LISTED)
    shown = F.substring_index("new", ":", -1)
    state = stored(known.withColumn("attempt", F.lit(0)).withColumn("new", new_form("kind", "form", F.lit(0))).withColumn("shown", shown))
    occurring = known.select("kind", F.substring_index("form", ":", -1).alias("shown")).distinct()
    attempt = 0
    while True:
        clash = state.where(~listed).join(occurring, ["kind", "shown"], "left_semi").select(*state.columns)
        first = F.min(F.struct((~listed).alias("late"), "attempt", "form")).alias("keeps")
        meet = state.groupBy("kind", "shown").agg(F.count("*").alias("n"), first).where("n > 1")
        second = state.join(meet, ["kind", "shown"]).where("form <> keeps.form").select(*state.columns)
        again = stored(clash.unionByName(second).select("kind", "form").distinct())
        count = again.count()
        if not count:
            return state.where("attempt > 0").select("kind", "form", "attempt")
        attempt += 1
        if attempt > LAST_ATTEMPT:
            raise ValueError(f"{count} entities still need another surrogate after {LAST_ATTEMPT} attempts; their formats leave too few forms")
        kept = state.join(again, ["kind", "form"], "left_anti")
        moved = again.withColumn("attempt", F.lit(attempt)).withColumn("new", new_form("kind", "form", F.lit(attempt))).withColumn("shown", shown)
        state = stored(kept.unionByName(moved))


def with_surrogates(documents: DataFrame, key: bytes, text: str = "text", count: str = "n_entities") -> DataFrame:
    """The documents with surrogates in place of personal data, and the number of mentions replaced.

    NULL stays NULL with 0 mentions; texts without a trace of an entity pass untouched and
    never reach Python. Repeated rows give equal texts; an empty table stays empty. Each text
    meets the exceptions it mentions by a join, which moves texts only if those are too many to broadcast.
    """
    mentions = _mentions(documents, text)
    found = mentions.join(_exceptions(mentions, key), ["kind", "form"])
    other = stored(found.groupBy(F.col("mark").alias("__mark")).agg(
        F.collect_set(F.concat_ws("\0", "kind", "attempt", "form")).alias("__other")))

    @F.pandas_udf("text string, n long")
    def swap(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.DataFrame]:
        for texts, others in batches:
            done = []
            for t, own in zip(texts, others, strict=True):
                split = [o.split("\0", 2) for o in own] if own is not None else []
                done.append((None, 0) if t is None else replaced(t, key, {(kind, form): int(n) for kind, n, form in split}))
            yield pd.DataFrame(done, columns=["text", "n"])

    joined = documents.withColumn("__mark", F.xxhash64(text)).join(other, "__mark", "left")
    inner = joined.withColumn("__new", swap(_suspect(F.col(text)), F.col("__other"))).drop("__mark", "__other")
    return inner.withColumn(text, F.coalesce("__new.text", F.col(text))).withColumn(count, F.coalesce("__new.n", F.lit(0))).drop("__new")
