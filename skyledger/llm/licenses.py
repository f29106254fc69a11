"""License scan: ordered signature rules behind a keyword filter.

A text is reduced to its lower-case words. An automaton finds the keywords in it; only the rules
of keywords that are there run. Rules are ordered: an earlier rule has priority. A detection
whose interval of words lies inside that of a detection with priority is suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterator
from dataclasses import dataclass

import ahocorasick
import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

# Phrases and labels of the base scan.
BASE = {
    "under the mit license": "mit",
    "apache license version 2": "apache-2",
    "cc by nc": "cc-by-nc",
}

# Licenses with their names in lower-case words and their versions, the words of a
# version separated by blanks. The first name is also the rule's keyword unless one is given.
# (label, identifier words, names, versions, keyword)
VERSIONED = [
    ("gpl", "gpl", r"(?:gnu )?general public licen[cs]e|(?:gnu )?gpl", ["1", "2", "3"], ["gpl", "general public"]),
    ("lgpl", "lgpl", r"(?:gnu )?(?:lesser|library) general public licen[cs]e|(?:gnu )?lgpl", ["2", "2 1", "3"], ["lgpl", "lesser general", "library general"]),
    ("agpl", "agpl", r"(?:gnu )?affero general public licen[cs]e|(?:gnu )?agpl", ["1", "3"], ["agpl", "affero"]),
    ("gfdl", "gfdl", r"(?:gnu )?free documentation licen[cs]e|gfdl", ["1 1", "1 2", "1 3"], ["gfdl", "free documentation"]),
    ("apache", "apache", r"apache(?: software)? licen[cs]e|apache", ["1 0", "1 1", "2"], ["apache"]),
    ("mpl", "mpl", r"mozilla public licen[cs]e|mpl", ["1 0", "1 1", "2"], ["mpl", "mozilla public"]),
    ("epl", "epl", r"eclipse public licen[cs]e|epl", ["1 0", "2"], ["epl", "eclipse public"]),
    ("eupl", "eupl", r"european union public licen[cs]e|eupl", ["1 0", "1 1", "1 2"], ["eupl", "european union public"]),
    ("cddl", "cddl", r"common development and distribution licen[cs]e|cddl", ["1 0", "1 1"], ["cddl", "common development and"]),
    ("cpl", "cpl", r"common public licen[cs]e", ["1 0"], ["common public"]),
    ("cecill", "cecill", r"cecill(?: free software)?(?: licen[cs]e)?", ["1", "2", "2 1"], ["cecill"]),
    ("artistic", "artistic", r"artistic licen[cs]e", ["1 0", "2"], ["artistic"]),
    ("osl", "osl", r"open software licen[cs]e", ["1 0", "2", "2 1", "3"], ["open software"]),
    ("afl", "afl", r"academic free licen[cs]e", ["1 1", "1 2", "2", "2 1", "3"], ["academic free"]),
    ("ofl", "ofl", r"(?:sil )?open font licen[cs]e|sil ofl", ["1 0", "1 1"], ["open font", "sil ofl"]),
    ("bsl", "bsl", r"boost software licen[cs]e", ["1 0"], ["boost software"]),
    ("ms-pl", "ms pl", r"microsoft public licen[cs]e", [], ["microsoft public"]),
    ("ms-rl", "ms rl", r"microsoft reciprocal licen[cs]e", [], ["microsoft reciprocal"]),
    ("mit", "mit", r"mit licen[cs]e|expat licen[cs]e|mit x11 licen[cs]e", [], ["mit", "expat"]),
    ("isc", "isc", r"isc licen[cs]e", [], ["isc"]),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[cs]e", [], ["zlib"]),
    ("unlicense", "unlicense", r"the unlicense", [], ["unlicense"]),
    ("wtfpl", "wtfpl", r"wtfpl|do what the fuck you want to public licen[cs]e", [], ["wtfpl", "do what the fuck"]),
    ("psf", "psf", r"python software foundation licen[cs]e", ["2"], ["python software foundation"]),
    ("postgresql", "postgresql", r"postgresql licen[cs]e", [], ["postgresql"]),
    ("ncsa", "ncsa", r"university of illinois (?:ncsa )?open source licen[cs]e", [], ["illinois"]),
    ("odbl", "odbl", r"open database licen[cs]e|odbl", ["1 0"], ["open database", "odbl"]),
    ("pddl", "pddl", r"public domain dedication and licen[cs]e", ["1 0"], ["public domain dedication"]),
    ("openssl", "openssl", r"openssl licen[cs]e", [], ["openssl"]),
    ("php", "php", r"php licen[cs]e", ["3 0", "3 01"], ["php"]),
    ("ruby", "ruby", r"ruby licen[cs]e", [], ["ruby"]),
    ("bsd-2-clause", "bsd 2 clause", r"(?:simplified|2 clause|two clause) bsd licen[cs]e|bsd 2 clause(?: licen[cs]e)?", [], ["bsd"]),
    ("bsd-3-clause", "bsd 3 clause", r"(?:new|modified|revised|3 clause|three clause) bsd licen[cs]e|bsd 3 clause(?: licen[cs]e)?", [], ["bsd"]),
    ("bsd-4-clause", "bsd 4 clause", r"(?:original|4 clause|four clause) bsd licen[cs]e|bsd 4 clause(?: licen[cs]e)?", [], ["bsd"]),
    ("bsd", "bsd", r"bsd(?: style)? licen[cs]e", [], ["bsd"]),
]
# Creative Commons terms and their long names, and versions.
COMMONS = {
    "by": "attribution",
    "by nc": "attribution non ?commercial",
    "by nc nd": "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?",
    "by nc sa": "attribution non ?commercial share ?alike",
    "by nd": "attribution no ?deriv(?:ative)?s?(?: works)?",
    "by sa": "attribution share ?alike",
}
COMMONS_VERSIONS = ["1 0", "2 0", "2 5", "3 0", "4 0"]
# Sentences of license texts.
SENTENCES = [
    ("mit", r"permission is hereby granted free of charge to any person obtaining a copy of this software", "permission is hereby granted"),
    ("isc", r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "permission to use copy"),
    ("bsd", r"redistribution and use in source and binary forms with or without modification are permitted", "redistribution and use"),
    ("bsd-3-clause", r"neither the name of (?:\S+ ){1,12}?nor the names of its contributors may be used to endorse", "neither the name of"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display", "all advertising materials"),
    ("apache-2", r"you may not use this file except in compliance with the license", "except in compliance with"),
    ("gpl", r"this program is free software you can redistribute it and or modify it under the terms of the gnu general public license", "this program is free software"),
    ("lgpl", r"under the terms of the gnu (?:lesser|library) general public license", "under the terms of the gnu"),
    ("mpl-2", r"this source code form is subject to the terms of the mozilla public license", "this source code form"),
    ("zlib", r"this software is provided as is without any express or implied warranty in no event will the authors be held liable", "in no event will the authors"),
    ("unlicense", r"this is free and unencumbered software released into the public domain", "unencumbered software"),
    ("public-domain", r"(?:released|dedicated|placed|is) (?:in|into|to) the public domain", "public domain"),
    ("all-rights-reserved", r"all rights reserved", "all rights reserved"),
]

LICENSED = (
    r"(?:licen[cs]ed|released|distributed|available|published|provided|shared) under "
    r"(?:(?:the )?terms of )?(?:the |a |an )?"
)


@dataclass(frozen=True)
class Rule:
    label: str
    pattern: str
    keywords: tuple[str, ...]
    score: float


def build_rules() -> list[Rule]:
    """All rules, those with priority first: identifiers, grants and license sentences with a
    version, names with a version, then the same without one."""
    tags, grants, names, loose_grants, loose = [], [], [], [], []

    def add(label: str, tag: str, name: str, keys: list[str], version: str | None) -> None:
        keys = tuple(keys)
        if version is None:
            tags.append(Rule(label, rf"spdx license identifier {tag}", ("spdx",), 1.0))
            loose_grants.append(Rule(label, rf"{LICENSED}(?:{name})", keys, 0.9))
            loose.append(Rule(label, rf"(?:{name})", keys, 0.6))
            return
        number = version + ("(?: 0)?" if " " not in version else "")
        said = rf"(?: licen[cs]e)?(?: version| v)? ?{number}"
        own = f"{label}-{version.replace(' ', '.')}"
        tags.append(Rule(own, rf"spdx license identifier {tag} {number}", ("spdx",), 1.0))
        grants.append(Rule(own, rf"{LICENSED}(?:{name}){said}", keys, 0.98))
        names.append(Rule(own, rf"(?:{name}){said}", keys, 0.85))
        grants.append(Rule(f"{own}-or-later", rf"(?:{name}){said} or (?:any|at your option any) later version",
                           keys, 0.95))

    for label, tag, name, versions, keys in VERSIONED:
        for version in versions:
            add(label, tag, name, keys, version)
        if label != "apache":
            add(label, tag, name, keys, None)
    for terms, long_name in COMMONS.items():
        label, tag = "cc-" + terms.replace(" ", "-"), f"cc {terms}"
        name = rf"(?:cc|creative commons) (?:{terms}|{long_name})(?! (?:nc|nd|sa|non|no|share))"
        for version in COMMONS_VERSIONS:
            add(label, tag, name, ["cc by", "creative commons"], version)
        add(label, tag, name, ["cc by", "creative commons"], None)
    add("cc0", "cc0", "cc0|creative commons zero", ["cc0", "commons zero"], "1 0")
    add("cc0", "cc0", "cc0|creative commons zero", ["cc0", "commons zero"], None)
    sentences = [Rule(label, text, (key,), 0.95) for label, text, key in SENTENCES[:-1]]
    last = [Rule(label, text, (key,), 0.3) for label, text, key in SENTENCES[-1:]]
    # A longer version first: "2 1" is not a "2".
    for group in (tags, grants, names):
        group.sort(key=lambda r: -len(r.label))
    return [*tags, *grants, *sentences, *names, *loose_grants, *loose, *last]


# Bytes of words: digits, a-z and everything beyond ASCII; A-Z lowered; the rest is a blank.
_WORD_BYTES = bytes(
    b + 32 if 65 <= b <= 90 else b if 48 <= b <= 57 or 97 <= b <= 122 or b >= 128 else 32
    for b in range(256)
)


def normal_words(text: str) -> tuple[str, int]:
    """The words with a blank before, between and after them, one character a byte; their number."""
    found = text.encode("utf-8", "surrogatepass").translate(_WORD_BYTES).split()
    return f" {b' '.join(found).decode('latin-1')} " if found else " ", len(found)


class Scanner:
    def __init__(self, rules: list[Rule]):
        self.rules = rules
        self.compiled = [re.compile(f" (?:{r.pattern})(?= )") for r in rules]
        gates: dict[str, list[int]] = {}
        for number, rule in enumerate(rules):
            for key in rule.keywords:
                gates.setdefault(f" {key} ", []).append(number)
        self.base = {f" {phrase} ": label for phrase, label in BASE.items()}
        for phrase in self.base:
            gates.setdefault(phrase, [])
        self.automaton = ahocorasick.Automaton()
        for key, numbers in gates.items():
            self.automaton.add_word(key, (key, numbers))
        self.automaton.make_automaton()

    def detect(self, text: str, gated: set[int]) -> list[tuple[int, int, int]]:
        """(rule, start, end) in characters of all places of the gated rules."""
        return [
            (number, m.start(), m.end())
            for number in sorted(gated)
            for m in self.compiled[number].finditer(text)
        ]

    def scan(self, text: str | None) -> dict:
        text, n_words = normal_words(text or "")
        gated, places = set(), []
        for end, (key, numbers) in self.automaton.iter(text):
            gated.update(numbers)
            if key in self.base:
                places.append((end - len(key) + 1, self.base[key]))
        kept = suppress(self.detect(text, gated)) if gated else []
        base = {label for _, label in places}
        labels = base | {self.rules[rule].label for rule, _, _ in kept}
        score = max([self.rules[rule].score for rule, _, _ in kept] + [0.9 * bool(base)])
        starts = [at for at, _ in places]
        # one blank before each word; sought once, however many places there are
        blanks = np.flatnonzero(np.frombuffer(
            text.encode("utf-32-le", "surrogatepass"), dtype="<u4") == ord(" ")
        ) if starts or kept else np.empty(0)

        def word(at: int) -> int:
            return int(np.searchsorted(blanks, at))

        return {
            "n_words": n_words, "n_base": len(places),
            "first_word": word(min(starts)) if starts else None,
            "last_word": word(max(starts)) if starts else None,
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)),
            "score": float(score),
            "detections": [
                {"label": self.rules[rule].label, "first": word(start),
                 "words": word(end) - word(start), "score": self.rules[rule].score}
                for rule, start, end in sorted(kept, key=lambda d: (d[1], d[2], d[0]))
            ],
        }


def suppress(found: list[tuple[int, int, int]]) -> list[tuple[int, int, int]]:
    """Detections outside every one with priority.

    Visited by priority, longer first. ``starts`` and ``ends`` hold the outermost intervals so
    far; both rise, so the last that starts no later has the greatest end: n log n.
    """
    kept, starts, ends = [], [], []
    for rule, start, end in sorted(found, key=lambda d: (d[0], d[1] - d[2], d[1])):
        at = bisect_right(starts, start)
        if at and ends[at - 1] >= end:
            continue
        kept.append((rule, start, end))
        # the intervals inside the new one are no longer outermost
        low, high = bisect_left(starts, start), bisect_right(ends, end)
        starts[low:high], ends[low:high] = [start], [end]
    return kept


SCHEMA = (
    "n_words long, n_base long, first_word long, last_word long, base_labels string, "
    "labels string, score double, "
    "detections array<struct<label: string, first: long, words: long, score: double>>"
)


def scan_licenses(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Licenses that every document names or contains.

    Returns doc_id, the number of words, the places of the base phrases (count, first and last
    word, labels), ``labels`` with those of the rules too, ``score`` (that of the best kept
    detection, at least 0.9 if a base phrase is there) and the kept detections with their first
    word and their length in words. Narrow: one pass, no shuffle, memory for one batch.

    Null and empty texts have no words and no labels. Rows are scanned one by one; repeated ids
    and other columns don't matter; an empty table gives an empty table.
    """
    rules = build_rules()

    def scan(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        scanner = Scanner(rules)
        for batch in batches:
            rows = [scanner.scan(text) for text in batch["text"]]
            out = pd.DataFrame(rows, index=batch.index, columns=[
                "n_words", "n_base", "first_word", "last_word", "base_labels", "labels",
                "score", "detections"])
            for name in ("first_word", "last_word"):
                out[name] = out[name].astype("Int64")
            out.insert(0, "doc_id", batch["doc_id"])
            yield out

    # ids travel as text, so that null ids and ids of any type come back as they were
    kind = df.schema[id_col].dataType.simpleString()
    slim = df.select(F.col(id_col).cast("string").alias("doc_id"), F.col(text_col).alias("text"))
    return slim.mapInPandas(scan, f"doc_id string, {SCHEMA}").withColumn(
        "doc_id", F.col("doc_id").cast(kind))
