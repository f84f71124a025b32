"""Licence notices in texts: exact phrases, and short notices with a bounded number of errors."""

from __future__ import annotations

from dataclasses import dataclass
from functools import lru_cache

import regex
from pyspark.sql import DataFrame

from outpulse.llm.common import by_batch, texts, words

#: Phrases whose words must stand consecutively, and their labels.
BASE = (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc"))
#: Short notices searched with errors: text of words, label, errors (insertions, deletions, substitutions of characters).
NOTICES = (
    ("released under the mit license", "mit", 3),
    ("released under the bsd license", "bsd", 3),
    ("released under the isc license", "isc", 3),
    ("released under the gpl license", "gpl", 3),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit", 6),
    ("licensed under the apache license version 2 0", "apache-2", 4),
    ("licensed under cc by nc 4 0", "cc-by-nc", 2),
    ("licensed under cc by nd 4 0", "cc-by-nd", 2),
    ("licensed under cc by sa 4 0", "cc-by-sa", 2),
    ("creative commons attribution noncommercial", "cc-by-nc", 4),
    ("creative commons attribution noderivatives", "cc-by-nd", 4),
    ("creative commons attribution sharealike", "cc-by-sa", 4),
    ("gnu affero general public license version 3", "agpl-3", 3),
    ("gnu general public license version 3", "gpl-3", 3),
    ("gnu general public license version 2", "gpl-2", 3),
    ("gnu lesser general public license", "lgpl", 3),
    ("mozilla public license version 2 0", "mpl-2", 3),
    ("redistribution and use in source and binary forms with or without modification are permitted", "bsd", 7),
    ("this is free and unencumbered software released into the public domain", "unlicense", 6),
    ("all rights reserved", "all-rights-reserved", 1),
)
#: Words that tell a notice from its neighbours: errors may touch any other word, these must stand as they are.
DECIDING = {"mit", "bsd", "isc", "gpl", "nc", "nd", "sa", "gnu", "affero", "lesser"}


@dataclass(frozen=True)
class Span:
    """A place in the joined words: character span, errors, label, the notice's words."""

    start: int
    end: int
    errors: int
    label: str
    phrase: str = ""


def seeds(phrase: str, errors: int) -> list[tuple[int, str]]:
    """The phrase cut into errors + 1 pieces with their places: with so many errors one stays whole."""
    cuts = [round(i * len(phrase) / (errors + 1)) for i in range(errors + 2)]
    return [(a, phrase[a:b]) for a, b in zip(cuts, cuts[1:])]


#: Licences whose notices are a few characters from each other; others are families of their own.
FAMILIES = {"gpl-2": "gpl", "gpl-3": "gpl", "lgpl": "gpl", "agpl-3": "gpl", "gpl": "gpl", "cc-by-nc": "cc", "cc-by-nd": "cc", "cc-by-sa": "cc"}
VERSION = regex.compile(r"version ([\d ]+)$")
#: Version numbers and errors of the notices that end in a version, by label.
VERSIONS = {label: (m[1].split(), errors) for phrase, label, errors in NOTICES if (m := VERSION.search(phrase))}


def of_version(span: Span, joined: str) -> bool:
    """Whether the numbers at the end of the span are those of its notice; later ones may be missing."""
    if span.label not in VERSIONS:
        return True
    numbers, errors = VERSIONS[span.label]
    around = len(" ".join(numbers)) + errors + 1
    end = joined.find(" ", min(len(joined) - 1, span.end + around))
    found = regex.findall(r"\d+", joined[max(span.start, span.end - around) : end if end >= 0 else len(joined)])[: len(numbers)]
    return bool(found) and found == numbers[: len(found)]


def decided(span: Span, joined: str) -> bool:
    """Whether the words that the span touches hold the deciding words of its notice, each whole."""
    start = joined.rfind(" ", 0, span.start + 1) + 1
    end = joined.find(" ", span.end - 1)
    around = joined[start : end if end >= 0 else len(joined)].split(" ")
    return all(word in around for word in span.phrase.split(" ") if word in DECIDING)


def resolved(spans: list[Span], joined: str) -> list[Span]:
    """Spans with the deciding words and the version of their notice; of overlapping ones in a family those of fewest errors."""
    kept = [x for x in spans if decided(x, joined) and of_version(x, joined)]
    family = lambda x: FAMILIES.get(x.label, x.label)
    return [x for x in kept if not any(family(y) == family(x) and y.errors < x.errors and y.start < x.end and x.start < y.end for y in kept)]


class Scanner:
    def __init__(self, notices=NOTICES, base=BASE):
        self.base = [(f" {phrase} ", label) for phrase, label in base]
        self.errors: dict[str, int] = {}
        for _, label, errors in notices:
            self.errors[label] = max(errors, self.errors.get(label, 0))
        self.notices = [
            (phrase, label, errors, seeds(phrase, errors), regex.compile(rf"(?e)(?:{regex.escape(phrase)}){{e<={errors}}}"))
            for phrase, label, errors in notices
        ]

    def exact(self, joined: str) -> list[tuple[int, str]]:
        """Every place of every base phrase: its first word's number and the label; ``joined`` has blanks at both ends."""
        places = []
        for phrase, label in self.base:
            at = joined.find(phrase)
            while at >= 0:
                places.append((at, label))
                at = joined.find(phrase, at + 1)
        places.sort()
        out, seen, number = [], 0, 0
        for at, label in places:
            number += joined.count(" ", seen, at)
            seen = at
            out.append((number, label))
        return out

    def fuzzy(self, joined: str) -> list[Span]:
        """Notices within their errors, as spans of characters.

        Every window that could hold a notice has one of its seeds in place;
        overlapping windows are joined, then each is searched.
        """
        spans = []
        for phrase, label, errors, pieces, pattern in self.notices:
            windows = []
            for offset, seed in pieces:
                at = joined.find(seed)
                while at >= 0:
                    windows.append((max(0, at - offset - errors - 1), at - offset + len(phrase) + errors + 1))
                    at = joined.find(seed, at + 1)
            windows.sort()
            merged: list[list[int]] = []
            for a, b in windows:
                if merged and a <= merged[-1][1]:
                    merged[-1][1] = max(b, merged[-1][1])
                else:
                    merged.append([a, b])
            for a, b in merged:
                for m in pattern.finditer(joined, a, min(b, len(joined))):
                    spans.append(Span(m.start(), m.end(), sum(m.fuzzy_counts), label, phrase))
        return spans


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


def scan(docs: DataFrame) -> DataFrame:
    """Licence places and labels of every whole text (null: empty).

    Per row: the number of words; base places, their count and first and last
    word (null without any); base labels and all labels; ``score``, 1 for an
    exact phrase, less for each error of the best notice, 0 without any; and
    the notices' spans as words (first, last) with label and errors.  Repeated
    rows are scanned again, an empty table gives no row, other columns are
    ignored.
    """

    def work(batch):
        s = scanner()
        out = {k: [] for k in ("n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "span_starts", "span_ends", "span_labels", "span_errors")}
        for text in batch.column("text").to_pylist():
            found = words(text)
            joined = f" {' '.join(found)} "
            base, spans = s.exact(joined), resolved(s.fuzzy(joined), joined)
            best = max([1.0] if base else [1 - x.errors / (s.errors[x.label] + 1) for x in spans], default=0.0)
            row = (
                len(found), len(base), base[0][0] if base else None, base[-1][0] if base else None,
                ",".join(sorted({b for _, b in base})), ",".join(sorted({b for _, b in base} | {x.label for x in spans})), best,
                [joined.count(" ", 1, x.start) for x in spans], [joined.count(" ", 1, max(1, x.end - 1)) for x in spans], [x.label for x in spans], [x.errors for x in spans],
            )
            for k, v in zip(out, row):
                out[k].append(v)
        return {"doc_id": batch.column("doc_id")} | out

    return by_batch(
        texts(docs),
        "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
        "span_starts array<long>, span_ends array<long>, span_labels array<string>, span_errors array<long>", work,
    )
