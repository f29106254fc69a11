"""Plain versions of what the operators compute."""

from __future__ import annotations

import re
from collections import Counter, defaultdict

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LICENSE_WORD = re.compile("[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall(text or "")


def base_licenses(text):
    found = LICENSE_WORD.findall((text or "").translate(LOWER))
    phrases = {"under the mit license": "mit", "apache license version 2": "apache-2",
               "cc by nc": "cc-by-nc"}
    places = [
        (k, label) for phrase, label in phrases.items() for k in range(len(found))
        if found[k:k + len(phrase.split())] == phrase.split()
    ]
    starts = [k for k, _ in places]
    return (len(found), len(places), min(starts, default=None), max(starts, default=None),
            ",".join(sorted({label for _, label in places})))


def quality_counts(text):
    found = words(text)
    seen, repeated = set(), 0
    for line in (text or "").split("\n"):
        if WORD.search(line):
            repeated += line in seen
            seen.add(line)
    windows = list(zip(found, found[1:], found[2:], strict=False))
    times = Counter(windows)
    covered = {k + i for k, w in enumerate(windows) if times[w] > 1 for i in range(3)}
    return (len(found), sum(map(len, found)), sum(map((text or "").count, "#*$%&|<>")), repeated,
            len(covered))


def components(nodes, links):
    parent = {n: n for n in nodes}

    def find(n):
        while parent[n] != n:
            n = parent[n]
        return n

    for a, b in links:
        a, b = sorted((find(a), find(b)))
        parent[b] = a
    return {n: find(n) for n in nodes}


def grams(text, size=5):
    found = words((text or "").lower())
    size = min(size, len(found))
    return {tuple(found[k:k + size]) for k in range(len(found) - size + 1)} if found else set()


def joined(rows, similarity=0.8):
    """doc_id: (links, component) of (doc_id, text) rows, all pairs compared."""
    sets = {i: grams(text) for i, text in rows}
    links = [
        (a, b) for a in sets for b in sets
        if a < b and sets[a] and sets[b]
        and len(sets[a] & sets[b]) >= similarity * len(sets[a] | sets[b])
    ]
    number = Counter(x for link in links for x in link)
    parts = components(list(sets), links)
    return {i: (number[i], parts[i]) for i in sets}


def deduped(rows, min_chars=40, min_docs=5):
    """doc_id: (lines, dropped, text kept) of (doc_id, text) rows."""
    blanks = " \t\n\x0b\x0c\r"
    keys = {i: [line.strip(blanks).translate(LOWER) for line in (text or "").split("\n")]
            for i, text in rows}
    holders = defaultdict(set)
    for i, own in keys.items():
        for key in own:
            if len(key) >= min_chars:
                holders[key].add(i)
    out = {}
    for i, text in rows:
        lines = (text or "").split("\n")
        kept = [line for line, key in zip(lines, keys[i], strict=True)
                if len(holders[key]) < min_docs or max(holders[key]) == i]
        out[i] = (len(lines), len(lines) - len(kept), "\n".join(kept))
    return out
