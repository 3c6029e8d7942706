import datetime
import re

import pytest

from ringside.llm import pii

from .test_pii import _luhn, _run

CARDS = ["4111 1111 1111 1111", "4111111111111111", "4111-1111-1111-1111", "3782 822463 10005"]
AROUND = ["card {} 12/25", "{} 123 cvv", "no 3 {}", "no 12 34 {} 567 89", "{} 5500 0055 5555 5559", "{} 123-45-6789", "{} 555-123-4567",
          "{} 2024-01-02", "{} 555 123 4567", "12/25 {}", "{} 12 34 56 78 90 12 34 56 78 90", "1 2 3 4 5 6 7 8 {}", "{} 12.50", "{} 12-3rd",
          "+44 20 7946 0958 {}", "+49 30 1234567 {}", "555-123-4567 {}", "{} 12/25/2024", "{} 4021@mail.example.com"]
PHONES = ["+44 20 7946 0958", "+33 1 23 45 67 89", "+49 30 12345678", "555 123 4567", "(555) 123 4567", "+1 (988) 555-2485", "+442079460958",
          "+44 (0)20 7946 0958", "555-123-4567", "+351.912.345.678"]


def test_cards_among_other_numbers(spark):
    cases = [(c, a.format(c)) for c in CARDS for a in AROUND]
    out = _run(spark, [t for _, t in cases])
    shape = lambda s: re.sub("[0-9]", "9", re.sub("[a-z]", "a", s))
    for i, (card, text) in enumerate(cases):
        new = out[i]["text"]
        assert shape(new) == shape(text) and card not in new, (text, new)
        for other in ("123-45-6789", "555-123-4567", "555 123 4567", "2024-01-02", "5500 0055 5555 5559", "20 7946", "30 1234567", "4021@"):
            assert other not in text or other not in new, (text, new)
        found = [m["value"] for m in out[i]["found"] if m["kind"] == "card"]
        assert found and all(_luhn(re.sub("[^0-9]", "", f)) and f in new for f in found), (text, new)


def test_a_card_has_one_pseudonym_beside_whatever_numbers(spark):
    texts = [a.format("4111 1111 1111 1111") for a in ("{}", "card {} 12/25", "no 3 {}", "{} 123 cvv", "{} 123-45-6789", "{}, 17")]
    out = _run(spark, texts)
    assert len({re.search(r"\d{4} \d{4} \d{4} \d{4}(?= \d| cvv|$|,)", r["text"][5 if "no 3" in t else 0:])[0] for t, r in
                ((texts[i], out[i]) for i in out)}) == 1


def test_phone_groupings(spark):
    texts = [f"call {p}{end}" for p in PHONES for end in ("", ".", " now", ", or write")]
    out = _run(spark, texts)
    for i, t in enumerate(texts):
        phone = PHONES[i // 4]
        assert [m["kind"] for m in out[i]["found"]] == ["phone"], t
        new = out[i]["text"]
        assert phone not in new and re.sub("[0-9]", "9", new) == re.sub("[0-9]", "9", t)
        assert len({out[j]["found"][0]["value"] for j in range(i - i % 4, i - i % 4 + 4)}) == 1


def test_what_is_no_value_stays(spark):
    texts = ["4111 1111 1111 1112 12/25", "1 2 3 4 5 6 7 8 9 10", "+12 345", "100 200 300", "9" * 50_000, "0 " * 5_000]
    out = _run(spark, texts)
    assert all(out[i]["text"] == texts[i] and out[i]["found"] == [] for i in range(len(texts)))


@pytest.mark.parametrize("first,step,n", [("0001-01-01", 6000, 115), ("1850-01-01", 37, 490), ("2100-04-01", 30_000, 96)])
def test_dates_of_every_century(spark, first, step, n):
    start = datetime.date.fromisoformat(first)
    days = [start + datetime.timedelta(days=step * i) for i in range(n)]
    out = _run(spark, [f"{d.year:04}-{d.month:02}-{d.day:02} or {d.day:02}.{d.month:02}.{d.year:04}" for d in days])
    seen = set()
    for i in range(n):
        a, b = out[i]["text"].split(" or ")
        seen.add(datetime.date.fromisoformat(a))
        assert b == f"{a[8:]}.{a[5:7]}.{a[:4]}" and len(out[i]["found"]) == 2
    assert len(seen) == n
