"""Base patterns by the contract's expressions; disclosing terms from counts."""

import re

import pytest

from tidemark.llm import pii as P

EMAIL = re.compile(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+")
IP = re.compile(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)")
CARD = re.compile(r"[0-9]([\x20-]?[0-9])+")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")


def luhn(d):
    total = 0
    for i, c in enumerate(reversed(d)):
        x = int(c) * (1 + i % 2)
        total += x - 9 if x > 9 else x
    return total % 10 == 0


def brute_force(text):
    text = text or ""
    out = [("email", m.start(), m.end()) for m in EMAIL.finditer(text)]
    out += [("ip", m.start(), m.end()) for m in IP.finditer(text) if all(int(p) <= 255 for p in m[0].split("."))]
    for m in CARD.finditer(text):
        d = re.sub("[ -]", "", m[0])
        if 16 <= len(d) <= 19 and luhn(d):
            out.append(("card", m.start(), m.end()))
    out += [("phone", m.start(), m.end()) for m in PHONE.finditer(text) if 8 <= len(re.sub("[^0-9]", "", m[0])) <= 15]
    return out


CASES = [
    None, "", "a@b.c", "x.y+z@mail-1.example.com, and b@c..d", "@@a@b@c.d.e@f.g", "é@a.b ü.a_b@x.y", "1.2.3.4.5.6.7.8", "256.1.1.1 001.002.003.004",
    "999999.1.1.1", "4111 1111 1111 1111", "4111-1111-1111-1112", "41111111111111111111111", "+1 (234) 555-5555", "+49.30.1234567.",
    "++12345678", "+1234567", "+1 2345678901234567", "a@b.c" * 50, "1" * 5000, "x" * 5000 + "@y.z", "1.2" * 999, "+1" * 99, "a.b@c.d@e.f",
]


@pytest.mark.parametrize("case", CASES)
def test_base_spans_are_the_contract_s(case):
    assert P.base_spans(case) == brute_force(case)


def test_base_spans_on_random_strings():
    import random

    rng = random.Random(1)
    for _ in range(4000):
        text = "".join(rng.choice("01239 -.+@ab()") for _ in range(rng.randint(0, 40)))
        assert P.base_spans(text) == brute_force(text)


@pytest.fixture(scope="module")
def mail(spark):
    """'reachable' stands only beside emails, 'the' everywhere, 'copied' beside one email that is copied often."""
    rows = [(i, f"The office of the town is reachable at p{i}@mail.example.com in the morning and the evening") for i in range(30)]
    rows += [(100 + i, "the town and the office and the morning in the evening " * 4) for i in range(60)]
    rows += [(200 + i, "copied text at same@mail.example.com") for i in range(20)]
    rows += [(300, "reachable without any mail"), (301, None), (302, ""), (302, "")]
    return spark.createDataFrame(rows, "doc_id bigint, text string")


def test_disclosing_terms(mail):
    got = {r["term"]: r for r in P.disclosing_terms(mail, disclose=0.8).collect()}
    assert "reachable" in got and not {"the", "copied", "text", "town"} & set(got)
    row = got["reachable"]
    assert (row["near"], row["n"]) == (30, 31)


def test_report_and_shards(mail):
    rows = {tuple(r) for r in P.find_spans(mail).collect()}
    terms = P.disclosing_terms(mail)
    assert rows == {tuple(r) for r in P.find_spans(mail, terms, shard_terms=1).collect()}
    by = {r[0]: r for r in rows}
    assert by[300][-2] == "" and by[301][1:5] == (0, 0, 0, 0)  # no entity: clean text is left alone
    for i in (0, 200):
        base = P.join_spans(brute_force(mail.where(f"doc_id = {i}").first()["text"]))
        assert by[i][-2].startswith(base)


def test_sanitised_text(mail):
    out = {r["doc_id"]: r["text"] for r in P.sanitise(mail, P.disclosing_terms(mail, disclose=0.8)).collect()}
    assert "@" not in out[0] and "[EMAIL]" in out[0] and "reachable" not in out[0]
    assert out[300] == "reachable without any mail" and out[301] is None


def test_odd_tables(docs, odd_docs, no_docs, rows):
    assert P.find_spans(docs).count() == len(rows) == P.find_spans(odd_docs).count()
    assert P.find_spans(no_docs).count() == 0 and P.sanitise(odd_docs).columns == odd_docs.columns


def test_terms_of_one_person(spark):
    """A name beside one phone in differing texts discloses it; copies of a text, or other entities in it, do not."""
    about = ["rain fell", "shops open", "trains stop", "birds sing", "doors shut", "lamps glow"]
    rows = [(i, f"In town the {x} and Zaphod answers +1 234 555 0100 while the {x} again") for i, x in enumerate(about)]
    rows += [(20 + i, f"copies of Marvin always say +1 234 555 0199 and p{i}@mail.example.com") for i in range(4)]
    rows += [(40 + i, "the town and the shops and the rain and trains again while birds sing " * 3) for i in range(40)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    terms = P.disclosing_terms(docs)
    got = {(r["term"], r["kind"]): r for r in terms.collect()}
    assert ("zaphod", "phone") in got and not {"marvin", "the", "town"} & {t for t, _ in got}
    assert (got["zaphod", "phone"]["near"], got["zaphod", "phone"]["n"]) == (6, 6)
    spans = {r["doc_id"]: r["spans"] for r in P.find_spans(docs, terms).collect()}
    at = rows[0][1].index("Zaphod")
    assert f"term:{at}:{at + 6}" in spans[0]


def test_near_words_have_no_window():
    text = "far " + "x" * 300 + " two three four" + " " * 500 + "a@b.c" + "\n" * 400 + "y" * 250 + " one two three four five"
    words = [(m.start(), m.end(), m[0]) for m in P._WORD.finditer(P._masked(text, P.base_spans(text)))]
    (_, a, b), = P.base_spans(text)
    assert P._near(words, a, b) == ["far", "x" * 300, "two", "three", "four", "y" * 250, "one", "two", "three", "four"]
