"""Pseudonyms: equal values in all formats, all kinds back again, and time that follows
the length of the text."""

import random
import re
import time

import pytest
from cohortlake.llm import pii

FEISTEL = pii.Feistel(b"key")


def new(text):
    return pii.replace(FEISTEL, text)[0]


@pytest.mark.parametrize("unit", ["a", "1", "1-", "@", "a@", "1.", "1 ", "+1", "AA11 ", "(111) ", "1/", "%1", "0123456789abcdef", "a.", "+1(1)"])
def test_five_megabytes_of_one_run(unit):
    text = "1@" + unit * (5_000_000 // len(unit))
    start = time.process_time()
    pii.replace(FEISTEL, text)
    assert time.process_time() - start < 4          # 1 s on an idle machine


def test_one_day_has_one_pseudonym():
    out = {new(t) for t in ("29.02.2024", "02/29/2024", "29/02/2024", "2024-02-29", "2024-02-29T10:00")}
    year, month, day = new("2024-02-29").split("-")
    assert out == {f"{day}.{month}.{year}", f"{month}/{day}/{year}", f"{year}-{month}-{day}", f"{year}-{month}-{day}T10:00"}


def test_one_number_has_one_pseudonym():
    digits = lambda t: re.sub(r"\D", "", t)
    forms = ["+1 (212) 555-7713", "+12125557713", "+1-212-555-7713", "(212) 555-7713", "212-555-7713", "212.555.7713"]
    assert len({digits(new(t))[-10:] for t in forms}) == 1 and all(new(t) != t for t in forms)
    assert digits(new("+49 171 5557713")) == digits(new("+491715557713")) and new("+491715557713").startswith("+49")
    assert digits(new("4539578763621486")) == digits(new("4539 5787 6362 1486")) == digits(new("4539-5787-6362-1486"))
    assert new("GB82 WEST 1234 5698 7654 32").replace(" ", "") == new("GB82WEST12345698765432")


def test_there_and_back():
    r = random.Random(1)
    d = lambda n: "".join(r.choice("0123456789") for _ in range(n))
    for _ in range(200):
        card = "4" + d(14)
        texts = [f"{d(2)}{r.choice('abc')}.x@y-z.example.org", f"+{r.choice(['1', '44', '353'])} {r.randrange(100, 999)} {d(3)}-{d(4)}",
                 f"({d(3)}) {d(3)}-{d(4)}", f"{r.randrange(1900, 2100)}-{r.randrange(1, 13):02}-{r.randrange(1, 29):02}",
                 f"{r.randrange(1, 29):02}.{r.randrange(1, 13):02}.{r.randrange(1900, 2100)}", card + str(pii.luhn(card)),
                 ".".join(str(r.randrange(256)) for _ in range(4)), f"{r.randrange(100, 600)}-{r.randrange(10, 99)}-{r.randrange(1000, 9999)}"]
        for t in texts:
            assert pii.replace(FEISTEL, new(t), back=True)[0] == t


def test_what_stays():
    for t in ("x" * 70 + "@example.org", "2024-13-01", "999-12-3456 000-12-3456", "4539578763621487", "1.2.3.456", "0171 5557713",
              "1-2-3-4-5", "v1.2.3.4.5", "a" * 32, "word" * 30):
        assert new(t) == t
