import re

import pytest

from tallyroom.llm import surrogates as s

KEY = b"test"


@pytest.mark.parametrize("size", [1, 2, 3, 10, 97, 260, 1000])
def test_permutations_are_one_to_one(size):
    assert sorted(s.permuted(v, size, KEY, "x") for v in range(size)) == list(range(size))


@pytest.mark.parametrize(("text", "kind", "form"), [
    ("mail Bob.7@Mail.example.com now", "email", "bob.7@mail.example.com"), ("at 10.0.255.3, then", "ip", "10.0.255.3"),
    ("call +1 (017) 555-7713 x", "phone", "10175557713"), ("card 9807915762804490 y", "card", "9807915762804490"),
    ("ssn 123-45-6789", "ssn", "123456789"), ("DE89 3704 0044 0532 0130 00", "iban", "de89370400440532013000")])
def test_entities_keep_their_format(text, kind, form):
    (start, end, k, f), = s.entities(text)
    assert (k, f) == (kind, form)
    new, count = s.replaced(text, KEY, {})
    assert count == 1 and text[start:end] not in new
    shape = lambda t: re.sub(r"[a-zàéü]", "a", re.sub("[A-Z]", "A", re.sub("[0-9]", "0", t)))
    if kind != "ip":
        assert shape(new) == shape(text)
    (_, _, again, _), = s.entities(new)
    assert again == kind


def test_card_checksums_keep_their_state():
    good, bad = "4111111111111111", "4111111111111112"
    for form, state in ((good, True), (bad, False)):
        new = s.surrogate("card", form, KEY)
        assert (s.luhn_digit(new[:-1]) == int(new[-1])) is state


def test_accounts_keep_country_and_check_digits():
    good = ["de89370400440532013000", "gb82west12345698765432", "fr1420041010050500013m02606"]
    assert all(s.iban_digits(f[:2], f[4:]) == int(f[2:4]) for f in good)
    for form in good:
        news = {s.surrogate("iban", f"{form[:2]}{d:02d}{form[4:]}", KEY) for d in range(100)}
        assert len(news) == 100 and {n[:2] for n in news} == {form[:2]}
        holds = s.surrogate("iban", form, KEY)
        assert holds != form and s.iban_digits(holds[:2], holds[4:]) == int(holds[2:4])
        assert sum(s.iban_digits(n[:2], n[4:]) == int(n[2:4]) for n in news) == 1


def test_addresses_stay_in_their_range():
    import ipaddress

    nets = [ipaddress.ip_network(f"{start}/{length}") for start, length in s.NETWORKS]

    def net(form):
        return next((n for n in nets if ipaddress.ip_address(form) in n), None)

    forms = [str(n[i]) for n in nets for i in (0, 1, 100, -1)] + ["8.8.8.8", "1.1.1.1", "192.0.3.9", "172.32.0.1", "223.255.255.255"]
    new = [s.surrogate("ip", f, KEY) for f in forms]
    assert [net(f) for f in forms] == [net(n) for n in new]
    assert len(set(new)) == len(forms)
    small = [f"198.51.100.{i}" for i in range(256)]
    assert sorted(s.surrogate("ip", f, KEY) for f in small) == sorted(small)
    late = [s.surrogate("ip", f, KEY, s.GROWS) for f in small]
    assert len(set(late)) == 256 and not any(map(net, late))


def test_a_full_range_and_unlisted_given_names_stay_apart(spark):
    names = [f"{a}{b}{c}" for a in "BCDF" for b in "aeiou" for c in "ln"]
    texts = [f"host 198.51.100.{i} up" for i in range(256)] + [f"Mr {n} Stonefield and Frau {n} came" for n in names]
    texts += ["Anna Keller, Maria Keller, Peter Keller and John Keller"]
    frame = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r["doc_id"]: r["text"] for r in s.with_surrogates(frame, KEY).collect()}
    hosts = {re.search(r"host (\S+) up", out[i])[1] for i in range(256)}
    assert len(hosts) == 256 and not hosts & {f"198.51.100.{i}" for i in range(256)}
    new = {}
    for i, n in enumerate(names):
        new[n] = re.match(r"Mr (\w+) ", out[256 + i])[1]
    given = [*new.values(), *re.findall(r"(\w+) \w+", out[len(texts) - 1])[:1]]
    assert len(set(given)) == len(given) and not set(new.values()) & set(names)


def test_people_match_gender_and_script_and_stay_one_person():
    text = "Mrs. Maria Keller met John Smith. Keller left; Smith stayed. Госпожа Анна Петрова пришла."
    new, count = s.replaced(text, KEY, {})
    assert count == 8 and not re.search("Maria|Keller|John|Smith|Анна|Петрова", new)
    words = re.findall(r"\w+", new)
    assert words[1] in s.GIVEN["latin", "f"] and words[4] in s.GIVEN["latin", "m"]
    assert words[2] == words[6] and words[5] == words[8]
    assert words[11] in s.GIVEN["cyrillic", "f"] and re.fullmatch("[А-Я][а-я]+", words[12])
    assert s.replaced(text, b"other", {})[0] != new


def test_corpus_stays_distinct_and_consistent(spark):
    rows = [(i, f"x +1 (0{i % 10}{i // 10 % 10}) 555-77{i // 100}{i % 10} and u{i % 7}@m.org, 1.2.3.{i % 256}") for i in range(300)]
    rows += [(1000, None), (1001, ""), (1002, "nothing here"), (1003, rows[0][1]), (1004, "y" * 200_000 + "@")]
    frame = spark.createDataFrame(rows, "doc_id long, text string").selectExpr("*", "1 as n_entities", "2 as n")
    out = {r["doc_id"]: r for r in s.with_surrogates(frame, KEY).collect()}
    assert out[1000]["text"] is None and out[1002]["text"] == "nothing here" and out[1000]["n_entities"] == 0
    assert out[1003]["text"] == out[0]["text"] and out[0]["n_entities"] == 3
    pairs = set()
    for i, text in rows[:300]:
        before, after = s.entities(text), s.entities(out[i]["text"])
        assert [e[2] for e in before] == [e[2] for e in after]
        pairs |= {(b[2], b[3], a[3]) for b, a in zip(before, after, strict=True)}
    originals = {(k, b) for k, b, _ in pairs}
    assert len(originals) == len(pairs) == len({(k, a) for k, _, a in pairs})
    assert not {(k, a) for k, _, a in pairs} & originals
    assert s.with_surrogates(frame.limit(0), KEY).count() == 0


def test_occurring_surrogates_are_replaced(spark):
    names = [a + b for a in "BCDFGHJKLMNPQRSTVWXYZ" for b in "aeiou"]
    frame = spark.createDataFrame([(i, f"Mr. {n}") for i, n in enumerate(names)], "doc_id long, text string")
    assert s.exceptions(frame, KEY)
    new = [r["text"] for r in s.with_surrogates(frame, KEY).collect()]
    assert len(set(new)) == len(names) and not {t[4:] for t in new} & set(names)


def test_exceptions_are_a_table_that_joins(spark):
    names = [a + b for a in "BCDFGHJKLMNPQRSTVWXYZ" for b in "aeiou"]
    frame = spark.createDataFrame([(i, f"Mr. {n} and Mr. {names[i - 1]}") for i, n in enumerate(names)], "__id long, text string")
    table = s.exceptions(frame, KEY)
    assert table.columns == ["kind", "form", "attempt"] and table.count() == len(names)  # all forms of the shape occur
    attempts = {(r["kind"], r["form"]): r["attempt"] for r in table.collect()}
    assert min(attempts.values()) >= s.GROWS
    out = s.with_surrogates(frame, KEY)
    assert out.columns == ["__id", "text", "n_entities"]
    assert {r["text"] for r in out.collect()} == {s.replaced(r["text"], KEY, attempts)[0] for r in frame.collect()}


def test_clashes_that_stay_are_an_error(spark, monkeypatch):
    monkeypatch.setattr(s, "LAST_ATTEMPT", 2)
    frame = spark.createDataFrame([(f"Mr. {a}{b}",) for a in "BCDFGHJKLMNPQRSTVWXYZ" for b in "aeiou"], "text string")
    with pytest.raises(ValueError, match="105 entities still need another surrogate"):
        s.exceptions(frame, KEY)


@pytest.mark.parametrize("form", ["νίκος", "小明王李", "محمدعلي", "דודכהן", "ñandúß", "٣٤٥٦٧٨"])
def test_other_alphabets_are_permuted(spark, form):
    new = s.surrogate("email", f"{form}@{form}.org", KEY)
    local, _, domain = new.partition("@")
    assert local != form and domain != f"{form}.org" and domain.endswith(".org") and len(local) == len(form)
    assert [(c.isalpha(), c.isdigit()) for c in local] == [(c.isalpha(), c.isdigit()) for c in form]
    text = f"to {form}@{form}.org now"
    assert s.replaced(text, KEY, {}) == (f"to {new} now", 1)
    assert s.exceptions(spark.createDataFrame([(text,)], "text string"), KEY).count() == 0


def test_late_attempts_lengthen_the_name_of_an_email():
    new, count = s.replaced("Bob@mail.org", KEY, {("email", "bob@mail.org"): 17})
    local, _, domain = new.partition("@")
    assert count == 1 and len(local) == 5 and domain.endswith(".org") and len(domain) == len("mail.org")
