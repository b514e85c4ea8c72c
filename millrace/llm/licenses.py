"""License scan: exact phrases, and short notices with a bounded number of typing errors.

A notice that may hold k errors is split into k + 1 parts: by the pigeonhole principle one of them stands in the text
unchanged. An automaton finds all parts of all notices in one pass; around each find the ``regex`` library matches the
whole notice with at most k errors and gives the span and the errors. Texts are searched as lower-cased words joined by
single blanks, so line breaks and punctuation inside a notice don't matter.

Defined results: a null or empty text has no words and no labels; repeated rows and null ids stay; other columns are
ignored; an empty table gives an empty one.
"""

from __future__ import annotations

from bisect import bisect
from functools import lru_cache

import ahocorasick
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from millrace.llm.common import keyed, per_text
from millrace.llm.decontaminate import plain_words

# The phrases of the base count and their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# Public license notices, their labels, and one error for about every ten characters.
NOTICES = (
    ("apache license", "apache"),
    ("general public license", "gpl"),
    ("licensed under the apache license version 2 0", "apache"),
    ("permission is hereby granted free of charge to any person obtaining a copy", "mit"),
    ("under the terms of the gnu general public license", "gpl"),
    ("gnu lesser general public license", "lgpl"),
    ("redistribution and use in source and binary forms", "bsd"),
    ("mozilla public license", "mpl"),
    ("eclipse public license", "epl"),
    ("creative commons attribution", "cc"),
    ("permission to use copy modify and or distribute this software", "isc"),
    ("this is free and unencumbered software released into the public domain", "unlicense"),
    ("all rights reserved", "reserved"),
)


def errors_allowed(notice: str) -> int:
    return max(1, len(notice) // 10)


def parts(notice: str, k: int) -> list[tuple[int, str]]:
    """k + 1 parts of nearly equal length with their places."""
    cuts = [len(notice) * i // (k + 1) for i in range(k + 2)]
    return [(a, notice[a:b]) for a, b in zip(cuts, cuts[1:])]


def apart(chars: str, pattern, windows: set[tuple[int, int]], least: int) -> list[tuple[int, int, int]]:
    """Matches (start, end, errors) that don't overlap: each window's best, the better ones first, then what is left beside them."""
    taken: list[tuple[int, int, int]] = []
    while windows:
        hits = []
        for low, high in windows:
            if m := pattern.search(chars, low, high):
                hits.append((sum(m.fuzzy_counts), *m.span(), low, high))
        windows = set()
        for errors, s, e, low, high in sorted(hits):
            at = bisect(taken, s, key=lambda t: t[0])
            for t in (taken[at - 1:at] + taken[at:at + 1]):
                if t[0] < e and s < t[1]:
                    break
            else:
                t = (s, e, errors)
                taken.insert(at, t)
            windows |= {(a, b) for a, b in ((low, min(t[0], high)), (max(t[1], low), high)) if b - a >= least}
    return taken


class Scanner:
    def __init__(self, notices=NOTICES, phrases=PHRASES):
        self.phrases = [(f" {p} ".encode(), label, len(p.split())) for p, label in phrases]
        self.notices, self.seeds, places = [], ahocorasick.Automaton(), {}
        for i, (notice, label) in enumerate(notices):
            k = errors_allowed(notice)
            pattern = regex.compile(rf"(?<= )(?:{regex.escape(notice, literal_spaces=True)}){{e<={k}}}(?= )", regex.BESTMATCH)
            self.notices.append((label, len(notice), k, pattern))
            for at, part in parts(notice, k):
                places.setdefault(part, []).append((i, at))
        for part, where in places.items():
            self.seeds.add_word(part, (len(part), where))
        self.seeds.make_automaton()

    def scan(self, text: str):
        """n_words, the starts and labels of phrases, and fuzzy spans (label, first word, last word, errors, score)."""
        words = plain_words(text)
        plain = b" " + b" ".join(words) + b" "
        base = []
        for phrase, label, _ in self.phrases:
            at = plain.find(phrase)
            while at >= 0:
                base.append((plain.count(b" ", 0, at), label))
                at = plain.find(phrase, at + 1)
        chars = plain.decode("latin-1")                # one character per byte
        near: dict[int, set[tuple[int, int]]] = {}
        for end, (length, where) in self.seeds.iter(chars):
            for i, at in where:
                _, size, k, _ = self.notices[i]
                low = end + 1 - length - at - k - 1
                near.setdefault(i, set()).add((max(low, 0), min(low + size + 2 * k + 2, len(chars))))
        found = []
        for i, windows in near.items():
            label, size, k, pattern = self.notices[i]
            for s, e, errors in apart(chars, pattern, windows, size - k):
                found.append((label, chars.count(" ", 0, s) - 1, chars.count(" ", 0, e) - 1, errors, 1 - errors / size))
        return len(words), sorted(base), sorted(found, key=lambda x: x[1:3] + x[:1])


@lru_cache(maxsize=1)
def scanner() -> Scanner:
    return Scanner()


SPANS = "array<struct<label: string, first: long, last: long, errors: int, score: double>>"


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_words, phrases (start, label) and notices (label, first and last word, errors, score) of each document."""
    def one(text):
        n, base, found = scanner().scan(text)
        names = ("label", "first", "last", "errors", "score")
        return n, [{"start": s, "label": x} for s, x in base], [dict(zip(names, f)) for f in found]

    return per_text(keyed(docs, id_col, text_col), one, f"n_words long, phrases array<struct<start: long, label: string>>, notices {SPANS}")


def report(docs: DataFrame) -> DataFrame:
    found = scan_licenses(docs)
    joined = lambda x: F.array_join(F.array_sort(F.array_distinct(x)), ",")
    return found.select(
        "doc_id", "n_words", F.size("phrases").cast("long").alias("n_base"),
        F.array_min("phrases.start").alias("first_word"), F.array_max("phrases.start").alias("last_word"),
        joined(F.col("phrases.label")).alias("base_labels"),
        joined(F.concat("phrases.label", "notices.label")).alias("labels"),
        F.greatest(F.when(F.size("phrases") > 0, 1.0).otherwise(0.0), F.coalesce(F.array_max("notices.score"), F.lit(0.0))).alias("score"),
        F.transform("notices", lambda x: F.concat_ws(":", x["label"], x["first"], x["last"], x["errors"])).alias("notice_spans"))
