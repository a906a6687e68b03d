"""Surrogates: type and format kept, equal entities equal, unlike entities unlike, collisions resolved."""

import re

import pytest

from strataflow.llm import pii
from strataflow.llm.shared import TEST_KEY
from tests.llm import fixtures

TEXT = (
    'Call +1 (017) 555-7713 or mail Und.34@mail7.example.com, ip 97.51.17.173 or 10.1.2.3; card 4845-1681-1440-7329, number 9807915762804490, '
    'token = "04dbebab91ab85687d33eeaaf9ac699e1188f962", IBAN DE89 3704 0044 0532 0130 00. Mr. John Smith met Mrs Smith; господин Иванов, Κυρία Παππά. '
    "Version 1.2.3.4567 and 999.1.1.1 and 12:30 stay."
)


def test_types_are_found():
    kinds = [e[0] for e in pii.entities(TEXT)]
    assert kinds == ["phone", "email", "ip", "ip", "card", "secret", "iban", "given", "family", "family", "family", "family"]


def test_formats_are_kept():
    new, marks = pii.replaced(TEXT, b"k")
    by = {}
    for kind, a, b, made in marks:
        by.setdefault(kind, []).append((TEXT[a:b], made))
    assert re.fullmatch(r"\+1 \(\d{3}\) 555-\d{4}", by["phone"][0][1]) and by["phone"][0][0] != by["phone"][0][1]
    assert re.fullmatch(r"[a-z]{3}\.\d{2}@[a-z]{4}\d\.example\.com", by["email"][0][1])
    assert by["ip"][1][1].startswith("10.") and all(all(int(x) < 256 for x in made.split(".")) for _, made in by["ip"])
    card = by["card"][0][1]
    assert re.fullmatch(r"4\d{3}-\d{4}-\d{4}-\d{4}", card) and pii.luhn(card.replace("-", ""))
    assert re.fullmatch(r"[0-9a-f]{40}", by["secret"][0][1])
    iban = by["iban"][0][1]
    assert re.fullmatch(r"DE\d{2}( \d{4}){4} \d{2}", iban) and pii._mod97(iban.replace(" ", "")) == 1
    families = dict(by["family"])
    assert len(families) == 3 and re.fullmatch("[А-Я][а-я]+", families["Иванов"]) and re.fullmatch("[Α-Ω][α-ωά-ώς]+", families["Παππά"])
    assert "9807915762804490" in new and "1.2.3.4567 and 999.1.1.1 and 12:30 stay" in new
    assert new.count(families["Smith"]) == 2 and "Smith" not in new


def test_names_of_any_length():
    """Four words, particles, initials, capitals, and the name again without its title; a sentence's other words stay."""
    text = (
        "Dr Anna Maria Luise Schmidt and Mr Juan de la Cruz met MRS JANE DOE. Later Schmidt told Cruz that Juan, "
        "Prof. J. R. van der Berg and Doe would come; schmidt the smith saw Mr brown and Schmidts."
    )
    new, marks = pii.replaced(text, b"k")
    old = [text[a:b] for _, a, b, _ in marks]
    assert old == ["Anna", "Maria", "Luise", "Schmidt", "Juan", "Cruz", "JANE", "DOE", "Schmidt", "Cruz", "Juan", "Berg", "Doe"]
    made = {}
    for word, (kind, _, _, m) in zip(old, marks):
        made.setdefault(word.casefold(), set()).add(m.casefold())
    assert all(len(v) == 1 for v in made.values()) and len({min(v) for v in made.values()}) == len(made)
    assert all(m.isupper() == w.isupper() for w, (_, _, _, m) in zip(old, marks))
    assert " de la " in new and "J. R. van der " in new and new.endswith("schmidt the smith saw Mr brown and Schmidts.")
    assert [k for k, _, _, _ in marks][:4] == ["given", "given", "given", "family"]


def test_distinct_in_a_shape_that_is_nearly_full(spark):
    """One-letter mailboxes, all but two in use: no two real ones get the same surrogate, however few attempts there are."""
    real = [f"{c}@mail.example.com" for c in "abcdefghijklmnopqrstuvwx"] + ["long.name@mail.example.com"]
    found = spark.createDataFrame([("email", m) for m in real], "kind string, entity string")
    for most in (1, 3, pii.ATTEMPTS):
        tried = {r.entity: r.attempt for r in pii.attempts(found, b"k", most).collect()}
        assert len({pii.surrogate(b"k", "email", m, tried.get(m, 0)) for m in real}) == len(real)


def test_made_up_names_never_run_out(spark):
    words = [f"n/{a}{b}{c}" for a in "bcdfg" for b in "aeiou" for c in "klmnprst"]
    found = spark.createDataFrame([("family", w) for w in words], "kind string, entity string")
    tried = {r.entity: r.attempt for r in pii.attempts(found, b"k").collect()}
    assert len({pii.surrogate(b"k", "family", w, tried.get(w, 0)) for w in words}) == len(words)
    assert len(pii.surrogate(b"k", "family", words[0], 15)) > len(pii.surrogate(b"k", "family", words[0], 0)) + 15


def test_gender_shapes_the_given_name():
    endings = pii.SYLLABLES["latin"][2]
    for word in ("robin", "kim", "alexandra"):
        made = {g: pii.surrogate(b"k", "given", f"{g}/{word}", 0).split("/")[1] for g in "mf"}
        assert all(name.endswith(endings[g]) for g, name in made.items())


@pytest.mark.parametrize("size", [1, 2, 10, 97, 1000])
def test_permutation(size):
    assert sorted(pii.permuted(b"k", i, size, "t") for i in range(size)) == list(range(size))


def test_equal_shapes_never_collide():
    cards = [c for c in (f"4{i:015d}" for i in range(4000)) if pii.luhn(c)]
    assert len({pii.surrogate(b"k", "card", c, 0) for c in cards}) == len(cards)
    mails = [f"ab.{i:02d}@mail{j}.example.com" for i in range(100) for j in range(9)]
    assert len({pii.surrogate(b"k", "email", m, 0) for m in mails}) == len(mails)
    assert pii.surrogate(b"k", "email", mails[0], 0) != pii.surrogate(b"other", "email", mails[0], 0)


def test_collisions_are_resolved(spark):
    """Two-letter names: some surrogates are real entities; after the check none is, and none is shared."""
    real = [f"{c}{d}@mail.example.com" for c in "abcdefgh" for d in "0123456789"]
    found = spark.createDataFrame([("email", m) for m in real], "kind string, entity string")
    tried = {r.entity: r.attempt for r in pii.attempts(found, b"k").collect()}
    made = [pii.surrogate(b"k", "email", m, tried.get(m, 0)) for m in real]
    assert len(set(made)) == len(real) and not set(made) & set(real)


def test_tables(spark):
    rows = [*fixtures.texts()[:20], (900, TEXT), (901, TEXT), (None, "mail und.34@mail7.example.com"), (902, None), (903, "")]
    docs = fixtures.table(spark, rows)
    new = pii.replace_private(docs, TEST_KEY)
    assert new.columns == docs.columns and new.count() == len(rows)
    got = [(r.doc_id, r.text, r.n_entities) for r in pii.private_report(docs, TEST_KEY).collect()]
    assert {(i, t) for i, t, _ in got} == {(i, None if t is None else pii.replaced(t, TEST_KEY)[0]) for i, t in rows}
    assert {n for i, _, n in got if i in (900, 901)} == {12} and {n for i, _, n in got if i in (902, 903)} == {0}
    mail = next(t for i, t, n in got if i is None and n == 1)
    assert mail.split()[1] in next(t for i, t, _ in got if i == 900)
    assert pii.private_report(docs.limit(0), TEST_KEY).collect() == []
