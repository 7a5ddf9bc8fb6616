import random
import re
import time

import pytest

from skyloom.llm.licenses import BASE_PHRASES, evaluate, parse_expression, scan_licenses, scan_text

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute(text):
    words = WORDS.findall("".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or ""))
    places = [(k, label) for phrase, label in BASE_PHRASES.items() for k in range(len(words)) if words[k : k + len(phrase.split())] == phrase.split()]
    starts = [p[0] for p in places]
    return len(words), len(places), min(starts, default=None), max(starts, default=None), ",".join(sorted({p[1] for p in places}))


@pytest.mark.parametrize(
    "text",
    [None, "", "under the MIT-License under the mit license", "cc by nc cc by nc", "Apache License, Version 2.0 é CC-BY_NC", "the mit license", "x" * 99 + " under the mit license" * 50],
)
def test_base_scan_equals_brute_force(text):
    assert scan_text(text)[:5] == brute(text)


@pytest.mark.parametrize(
    ("text", "postfix", "value"),
    [
        ("MIT", ["mit"], 1.0),
        ("MIT OR GPL-3.0-only", ["mit", "gpl-3.0-only", "or"], 1.0),
        ("MIT AND GPL-3.0-only OR ISC", ["mit", "gpl-3.0-only", "and", "isc", "or"], 1.0),
        ("MIT AND (GPL-3.0-only OR AGPL-3.0-only)", ["mit", "gpl-3.0-only", "agpl-3.0-only", "or", "and"], 0.4),
        ("GPL-2.0-only WITH Classpath-exception-2.0", ["gpl-2.0-only", "classpath-exception-2.0", "with"], 0.7),
    ],
)
def test_expressions(text, postfix, value):
    assert parse_expression(text) == postfix
    assert evaluate(postfix) == pytest.approx(value)


@pytest.mark.parametrize("text", ["", "MIT OR", "(MIT", "MIT)", "MIT ISC", "AND MIT"])
def test_broken_expressions(text):
    assert parse_expression(text) is None


def test_tags_and_odd_rows(spark, odd, none):
    text = "# SPDX-License-Identifier: (MIT OR Apache-2.0) AND MPL-2.0 */ more words\nrest"
    assert scan_text(text)[5] == "apache-2,mit,mpl-2" and scan_text(text)[7] == 0.7
    rows = scan_licenses(odd).collect()
    assert len(rows) == 10 and all(0 <= r.score <= 1 for r in rows)
    assert next(r for r in rows if r.doc_id == 1).base_labels == "mit"
    assert scan_licenses(none).count() == 0


def test_random_texts_equal_brute_force():
    rng = random.Random(3)
    parts = ["under", "the", "mit", "license", "apache", "version", "2", "cc", "by", "nc", "MIT", "é", "-", "/", "\n"]
    for _ in range(300):
        text = rng.choice(["", " "]).join(rng.choice(parts) + rng.choice([" ", " ", "-"]) for _ in range(rng.randrange(60)))
        assert scan_text(text)[:5] == brute(text)


def test_places_of_tags_are_word_numbers():
    text = "one two\nSPDX-License-Identifier: MIT\nthree SPDX-License-Identifier: ISC"
    assert [(x["label"], x["word"]) for x in scan_text(text)[9]] == [("mit", 5), ("isc", 10)]


@pytest.mark.parametrize("unit", ["cc by nc ", "SPDX-License-Identifier: MIT ", "SPDX-License-Identifier: MIT OR "])
def test_a_million_words_take_linear_time(unit):
    n = 400_000 // len(unit.split())
    began = time.process_time()
    scan_text(unit * (n // 4))
    quarter = time.process_time() - began
    began = time.process_time()
    assert scan_text(unit * n)[0] >= n
    assert time.process_time() - began < 10 * quarter + 1
