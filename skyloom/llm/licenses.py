"""Licence scans (operator 2).

An Aho-Corasick automaton finds notice phrases (over normalised words) and identifier tags (over the raw
text) in one pass each; the expression behind a tag goes through a shunting-yard parser that evaluates
``and``, ``or`` and ``with``. Rows are independent, so a scan is one map over the table.

Edge cases: a null or empty text has no words and no places; a null id stays null; an expression that
does not parse gives its known identifiers and no evaluation; repeated rows give repeated results; an
empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import cache

import ahocorasick
import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Notice phrases of the base scan and their labels.
BASE_PHRASES = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}
# Further notice phrases, as normalised words, and their labels.
NOTICES = {
    "permission is hereby granted free of charge to any person obtaining a copy": "mit",
    "redistribution and use in source and binary forms with or without modification": "bsd",
    "neither the name of the copyright holder nor the names of its contributors": "bsd-3-clause",
    "permission to use copy modify and or distribute this software for any purpose": "isc",
    "gnu general public license version 2": "gpl-2",
    "gnu general public license version 3": "gpl-3",
    "gnu lesser general public license": "lgpl",
    "gnu affero general public license": "agpl-3",
    "mozilla public license version 2": "mpl-2",
    "eclipse public license": "epl",
    "boost software license version 1": "bsl-1",
    "european union public licence": "eupl",
    "creative commons attribution 4 0": "cc-by-4",
    "creative commons attribution sharealike": "cc-by-sa",
    "creative commons attribution noncommercial": "cc-by-nc",
    "cc by sa": "cc-by-sa",
    "cc by nd": "cc-by-nd",
    "cc0 1 0 universal": "cc0",
    "this is free and unencumbered software released into the public domain": "unlicense",
    "all rights reserved": "all-rights-reserved",
}
# Identifiers, the label of each and how freely it lets a text be used (0 to 1).
IDENTIFIERS = {
    "mit": ("mit", 1.0),
    "isc": ("isc", 1.0),
    "0bsd": ("0bsd", 1.0),
    "bsd-2-clause": ("bsd-2-clause", 1.0),
    "bsd-3-clause": ("bsd-3-clause", 1.0),
    "apache-2.0": ("apache-2", 1.0),
    "bsl-1.0": ("bsl-1", 1.0),
    "zlib": ("zlib", 1.0),
    "unlicense": ("unlicense", 1.0),
    "cc0-1.0": ("cc0", 1.0),
    "cc-by-4.0": ("cc-by-4", 0.9),
    "cc-by-sa-4.0": ("cc-by-sa", 0.6),
    "mpl-2.0": ("mpl-2", 0.7),
    "epl-2.0": ("epl", 0.7),
    "eupl-1.2": ("eupl", 0.6),
    "lgpl-2.1-only": ("lgpl", 0.6),
    "lgpl-2.1-or-later": ("lgpl", 0.6),
    "lgpl-3.0-only": ("lgpl", 0.6),
    "lgpl-3.0-or-later": ("lgpl", 0.6),
    "gpl-2.0-only": ("gpl-2", 0.4),
    "gpl-2.0-or-later": ("gpl-2", 0.4),
    "gpl-3.0-only": ("gpl-3", 0.4),
    "gpl-3.0-or-later": ("gpl-3", 0.4),
    "agpl-3.0-only": ("agpl-3", 0.3),
    "agpl-3.0-or-later": ("agpl-3", 0.3),
    "cc-by-nc-4.0": ("cc-by-nc", 0.2),
    "cc-by-nd-4.0": ("cc-by-nd", 0.1),
}
TAG = "spdx-license-identifier:"
#: Part of the doubt that one place of each kind of evidence removes.
WEIGHTS = {"base": 0.8, "notice": 0.7, "tag": 0.9}
PRECEDENCE = {"or": 1, "and": 2, "with": 3}
#: What an exception behind ``with`` gives back of the freedom that its licence lacks.
EXCEPTION_GAIN = 0.5

RESULT = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double, freedom double, expressions array<string>, spans array<struct<label string, word long, kind string>>"
)

_SEPARATORS = bytes(c for c in range(0x80) if not (0x30 <= c <= 0x39 or 0x61 <= c <= 0x7A or 0x41 <= c <= 0x5A))
_NORMAL = bytes.maketrans(
    _SEPARATORS + bytes(range(0x41, 0x5B)), b" " * len(_SEPARATORS) + bytes(range(0x61, 0x7B))
)
_LOWER = bytes.maketrans(bytes(range(0x41, 0x5B)), bytes(range(0x61, 0x7B)))
_TOKENS = re.compile(r"[()]|[A-Za-z0-9.+:-]+")
_LINE_TOKENS = re.compile(r"[()\n]|[A-Za-z0-9.+:-]+")


@cache
def _automata() -> tuple[ahocorasick.Automaton, ahocorasick.Automaton]:
    words, tags = ahocorasick.Automaton(), ahocorasick.Automaton()
    for phrase, label in NOTICES.items():
        words.add_word(f" {phrase} ", (len(phrase) + 2, label, "notice"))
    for phrase, label in BASE_PHRASES.items():
        words.add_word(f" {phrase} ", (len(phrase) + 2, label, "base"))
    tags.add_word(TAG, len(TAG))
    words.make_automaton()
    tags.make_automaton()
    return words, tags


def parse_expression(text: str) -> list[str] | None:
    """Shunting-yard: a licence expression in postfix order, or None where it does not parse."""
    out: list[str] = []
    stack: list[str] = []
    operand = True  # what must come next
    for token in _TOKENS.findall(text):
        low = token.lower()
        if token == "(":
            if not operand:
                return None
            stack.append(token)
        elif token == ")":
            if operand:
                return None
            while stack and stack[-1] != "(":
                out.append(stack.pop())
            if not stack:
                return None
            stack.pop()
        elif low in PRECEDENCE:
            if operand:
                return None
            while stack and stack[-1] != "(" and PRECEDENCE[stack[-1]] >= PRECEDENCE[low]:
                out.append(stack.pop())
            stack.append(low)
            operand = True
        else:
            if not operand:
                return None
            out.append(low)
            operand = False
    if operand or "(" in stack:
        return None
    return out + stack[::-1]


def evaluate(postfix: list[str], unknown: float = 0.0) -> float:
    """Freedom of use: ``or`` offers the freer side, ``and`` binds to the stricter, ``with`` eases its licence."""
    stack: list[float | str] = []
    value = lambda x: IDENTIFIERS.get(x.removesuffix("+"), ("", unknown))[1] if isinstance(x, str) else x
    for token in postfix:
        if token == "with":
            _, x = stack.pop(), value(stack.pop())
            stack.append(x + (1 - x) * EXCEPTION_GAIN)
        elif token in PRECEDENCE:
            b, a = value(stack.pop()), value(stack.pop())
            stack.append(max(a, b) if token == "or" else min(a, b))
        else:
            stack.append(token)
    return value(stack[0])


def expression_labels(text: str) -> list[str]:
    """Labels of the known identifiers in an expression."""
    names = (t.lower().removesuffix("+") for t in _TOKENS.findall(text))
    return [IDENTIFIERS[n][0] for n in names if n in IDENTIFIERS]


def _expression(text: str, at: int) -> str:
    """The expression behind a tag that ends before ``at``: up to where it stops parsing, the line's end at most."""
    kept: list[str] = []
    operand, depth = True, 0
    for m in _LINE_TOKENS.finditer(text, at):
        token, low = m[0], m[0].lower()
        if token == "\n":
            break
        if low in PRECEDENCE or token == ")":
            if operand or (token == ")" and not depth):
                break
            depth -= token == ")"
            operand = token != ")"
        elif not operand:
            break
        else:
            depth += token == "("
            operand = token == "("
            token = token.rstrip(".:-") if token != "(" else token
        kept.append(token)
    while kept and kept[-1].lower() in PRECEDENCE:
        kept.pop()
    return " ".join(kept)


def scan_text(text: str | None) -> tuple:
    """All of ``RESULT`` for one text, without its id."""
    words, tags = _automata()
    raw = (text or "").encode()
    plain = raw.translate(_NORMAL)
    tokens = plain.split()
    flat = b" ".join([b"", *tokens, b""]).decode("latin-1")
    found = [(end - size + 1, label, kind) for end, (size, label, kind) in words.iter(flat)]
    if found:  # a word's number is that of the space before it
        spaces = np.flatnonzero(np.frombuffer(flat.encode("latin-1"), np.uint8) == 0x20)
        places = np.searchsorted(spaces, [x[0] for x in found]).tolist()
        found = [(n, label, kind) for n, (_, label, kind) in zip(places, found, strict=True)]
    base = [x for x in found if x[2] == "base"]
    expressions, freedom, spans = [], None, list(found)
    if b"license identifier" in plain:
        letters = np.frombuffer(plain, np.uint8) != 0x20
        starts = np.flatnonzero(letters & ~np.append(False, letters[:-1]))  # of words
        text = raw.decode("latin-1")
        for end, _ in tags.iter(raw.translate(_LOWER).decode("latin-1")):
            if e := _expression(text, end + 1):
                expressions.append(e)
                word = int(np.searchsorted(starts, end + 1))
                spans += [(word, x, "tag") for x in expression_labels(e)]
                if (postfix := parse_expression(e)) is not None:
                    freedom = min(evaluate(postfix), 1.0 if freedom is None else freedom)
    doubt = 1.0
    for kind in {(label, kind) for _, label, kind in spans}:
        doubt *= 1 - WEIGHTS[kind[1]]
    starts = [x[0] for x in base]
    return (
        len(tokens), len(base), min(starts, default=None), max(starts, default=None),
        ",".join(sorted({x[1] for x in base})), ",".join(sorted({x[1] for x in spans})), 1 - doubt, freedom,
        expressions, [{"label": label, "word": word, "kind": kind} for word, label, kind in sorted(spans)],
    )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Licence evidence of every whole text of ``docs(doc_id, text)``; returns ``RESULT``.

    ``base_labels`` and ``labels`` are empty strings without evidence; ``freedom`` is the evaluated
    expression (null without one) and ``score`` the confidence that a licence is named.
    """
    names = re.findall(r"(\w+) (?:long|string|double|array<s\w+(?:<.*>)?>)(?:,|$)", RESULT)
    span = pa.struct([("label", pa.string()), ("word", pa.int64()), ("kind", pa.string())])
    kinds = [pa.int64()] * 5 + [pa.string()] * 2 + [pa.float64()] * 2 + [pa.list_(pa.string()), pa.list_(span)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 512):
                part = batch.slice(at, 512)
                rows = [scan_text(t) for t in part.column(1).to_pylist()]
                columns = [part.column(0), *([r[k] for r in rows] for k in range(10))]
                yield pa.RecordBatch.from_arrays([pa.array(c, k) if isinstance(c, list) else c for c, k in zip(columns, kinds, strict=True)], names)

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, RESULT)


def op2_license_scan(spark, sf_dir: str) -> DataFrame:
    """Licence evidence of all documents."""
    return scan_licenses(spark.read.parquet(f"{sf_dir}/documents.parquet"))
