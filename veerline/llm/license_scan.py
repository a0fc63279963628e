"""License scan: exact seeds find places where a notice may stand, bounded-error matching verifies them."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache, partial
from itertools import pairwise

import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# What separates words, and the phrases whose exact places are counted.
SEPARATORS = r"[\x00-\x2F\x3A-\x60\x7B-\x7F]+"
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))


@dataclass(frozen=True)
class Notice:
    """A notice matches with at most ``edits`` character edits if the words of ``exact`` stand in it unchanged."""

    phrase: str
    label: str
    edits: int
    exact: tuple[str, ...] = ()


NOTICES = (
    Notice("under the mit license", "mit", 2, ("mit",)),
    Notice("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    Notice("apache license version 2", "apache-2", 2, ("2",)),
    Notice("licensed under the apache license", "apache", 3),
    Notice("cc by nc", "cc-by-nc", 0),
    Notice("creative commons attribution noncommercial", "cc-by-nc", 4),
    Notice("creative commons attribution sharealike", "cc-by-sa", 3),
    Notice("gnu general public license", "gpl", 2, ("general",)),
    Notice("gnu lesser general public license", "lgpl", 3, ("general",)),
    Notice("mozilla public license", "mpl", 2),
    Notice("redistribution and use in source and binary forms", "bsd", 4),
    Notice("this is free and unencumbered software released into the public domain", "unlicense", 6),
    Notice("all rights reserved", "all-rights-reserved", 1),
)


def seeds(notice: Notice) -> list[tuple[int, str]]:
    """The phrase in edits + 1 pieces: a text within that many edits holds one of them unchanged."""
    n, k = len(notice.phrase), notice.edits + 1
    cuts = [i * n // k for i in range(k + 1)]
    return [(a, notice.phrase[a:b]) for a, b in pairwise(cuts)]


@lru_cache(maxsize=None)
def _compiled(notice: Notice):
    fuzzy = f"(?:{regex.escape(notice.phrase, special_only=True)}){{e<={notice.edits}}}"
    return regex.compile(rf"(?<= )(?e){fuzzy}(?= )"), seeds(notice)


def word_numbers(text: str, places: set[int]) -> dict[int, int]:
    """How many words stand before each place, counted in one pass over the text."""
    numbers, last, n = {}, 0, 0
    for at in sorted(places):
        n += text.count(" ", last, at)
        numbers[at], last = n, at
    return numbers


def find(text: str, notices: tuple[Notice, ...]) -> list[tuple[str, int, int, int, int]]:
    """(label, first word, words, edits, characters of the notice) of every verified place, words between single spaces."""
    found: dict[tuple[str, int, int], tuple[int, int]] = {}
    for notice in notices:
        pattern, pieces = _compiled(notice)
        spans: list[list[int]] = []
        places = set()
        for offset, piece in pieces:
            at = text.find(piece)
            while at >= 0:
                places.add(at - offset)
                at = text.find(piece, at + 1)
        slack = notice.edits + 1
        for at in sorted(places):
            a, b = max(0, at - slack), min(len(text), at + len(notice.phrase) + slack)
            if spans and a <= spans[-1][1]:
                spans[-1][1] = max(b, spans[-1][1])
            else:
                spans.append([a, b])
        for a, b in spans:
            for m in pattern.finditer(text, a, b, overlapped=True):
                words = m.group().split(" ")
                if all(w in words for w in notice.exact) and m.start() > 0:
                    key = (notice.label, m.start(), len(words))
                    now = sum(m.fuzzy_counts), len(notice.phrase)
                    # Of two notices the one that is nearer, by its own length.
                    found[key] = min(now, found.get(key, now), key=lambda x: x[0] / x[1])
    numbers = word_numbers(text, {at for _, at, _ in found})
    return sorted((label, numbers[at] - 1, words, *now) for (label, at, words), now in found.items())


def base_places(text: str) -> list[tuple[str, int]]:
    """(label, first word) of every exact phrase."""
    found = []
    for phrase, label in BASE:
        at = text.find(f" {phrase} ")
        while at >= 0:
            found.append((label, at))
            at = text.find(f" {phrase} ", at + 1)
    numbers = word_numbers(text, {at for _, at in found})
    return [(label, numbers[at]) for label, at in found]


SPAN = pa.struct([("label", pa.string()), ("first", pa.int64()), ("words", pa.int64()), ("edits", pa.int64()), ("size", pa.int64())])
SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double,"
    " spans array<struct<label:string,first:long,words:long,edits:long,size:long>>"
)


def _scan(batches: Iterator[pa.RecordBatch], notices: tuple[Notice, ...]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        rows = []
        for text in batch.column(1).to_pylist():
            base = base_places(text)
            spans = find(text, notices)
            starts = [s for _, s in base]
            labels = sorted({x for x, _ in base})
            best = max([1.0 - e / n for _, _, _, e, n in spans] + [1.0] * bool(base), default=0.0)
            rows.append((
                max(0, text.count(" ") - 1), len(base), min(starts, default=None), max(starts, default=None),
                ",".join(labels), ",".join(sorted({*labels, *(s[0] for s in spans)})), best,
                [dict(zip(("label", "first", "words", "edits", "size"), s)) for s in spans],
            ))
        kinds = [pa.int64()] * 4 + [pa.string()] * 2 + [pa.float64(), pa.list_(SPAN)]
        names = [part.split()[0] for part in SCHEMA.split(", ")]
        columns = [pa.array(c, k) for c, k in zip(zip(*rows) if rows else [[]] * 8, kinds)]
        yield pa.RecordBatch.from_arrays([batch.column(0), *columns], ["key", *names])


def scan_licenses(docs: DataFrame, notices: tuple[Notice, ...] = NOTICES, key: str = "doc_id", text: str = "text") -> DataFrame:
    """Per row of ``docs``: words, exact phrases (count, first, last, labels), all labels, score and spans.

    A-Z are lower-cased and the words put between single spaces by Spark; the notices are searched in that
    text, whole. A span has the place and number of its words, its edits and the length of the notice that
    it matches; the score is 1 less the best span's edits over that length, 0 without one. Null and empty texts have no words and no labels; repeated rows give
    repeated results; an empty table gives an empty one. Only key and text are read. No shuffle.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    small = F.translate(F.coalesce(F.col(text), F.lit("")), upper, lower)
    words = F.regexp_replace(F.concat(F.lit(" "), small, F.lit(" ")), SEPARATORS, " ")
    kind = docs.select(F.col(key).alias("key")).schema["key"].dataType.simpleString()
    rows = docs.select(F.col(key).alias("key"), words.alias("_words"))
    return rows.mapInArrow(partial(_scan, notices=notices), f"key {kind}, {SCHEMA}").withColumnRenamed("key", key)
