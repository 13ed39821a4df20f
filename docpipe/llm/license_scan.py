"""Licence scans: ordered signature rules behind a keyword prefilter.

One Aho-Corasick automaton per task finds the keywords of all rules, and the base phrases, in
one pass over a text's words. Only rules whose keyword occurs are searched for. Detections
overlap ("GNU GPL version 2 or later" holds four names); one whose interval lies within that
of a rule of higher priority, or of a longer match of equal priority, is suppressed.
"""

from __future__ import annotations

import re
from bisect import bisect_right
from itertools import groupby

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .license_rules import Rule, rules
from .shared import trim, utf8

#: Phrases whose every place is told, and their labels.
BASE = {"gnu general public license": "gpl", "apache license": "apache", "cc by": "cc-by", "mit license": "mit"}
BASE_WEIGHT = 0.6
#: A-Z to a-z; all other ASCII but letters and digits stands between words.
WORDS = bytes(b + 32 if 65 <= b <= 90 else b if b >= 0x80 or 0x30 <= b <= 0x39 or 0x61 <= b <= 0x7A else 32 for b in range(256))


def suppress(found: list[tuple[int, int, int, int]]) -> list[tuple[int, int, int, int]]:
    """Detections (priority, start, end, rule) that no better one contains, in order of start.

    Better is a lower priority number, then a longer interval, then an earlier rule. What a
    suppressed detection contains is contained in what suppressed it, so one sweep for each
    priority over the kept intervals, with the furthest end up to each start, is enough.
    """
    kept: list[tuple[int, int, int, int]] = []
    for _, level in groupby(sorted(found, key=lambda d: (d[0], d[1], -d[2], d[3])), key=lambda d: d[0]):
        starts, ends, far = [], [], -1
        for d in sorted(kept, key=lambda d: d[1]):
            far = max(far, d[2])
            starts.append(d[1])
            ends.append(far)
        far = -1
        for d in level:
            before = bisect_right(starts, d[1])
            if max(far, ends[before - 1] if before else -1) < d[2]:
                kept.append(d)
                far = d[2]
    return sorted(kept, key=lambda d: (d[1], d[2], d[3]))


class Scanner:
    """Compiled rules and the automaton of their keywords."""

    def __init__(self, of: tuple[Rule, ...], base: dict[str, str]):
        self.rules = of
        self.search = [re.compile(rf" (?:{r.pattern})(?= )").finditer for r in of]
        self.base = list(base.items())
        gates: dict[str, tuple[list[int], list[int]]] = {}
        for k, r in enumerate(of):
            gates.setdefault(r.keyword, ([], []))[0].append(k)
        for k, (phrase, _) in enumerate(self.base):
            gates.setdefault(f" {phrase} ", ([], []))[1].append(k)
        self.gate = ahocorasick.Automaton()
        for key, (some, phrases) in gates.items():
            self.gate.add_word(key, (len(key), tuple(some), tuple(phrases)))
        self.gate.make_automaton()

    def scan(self, text: bytes) -> dict:
        words = text.translate(WORDS).split()
        padded = f" {b' '.join(words).decode()} "
        open_, places = set(), []
        for last, (n, some, phrases) in self.gate.iter(padded):
            open_.update(some)
            places.extend((last - n + 1, k) for k in phrases)
        found = [(self.rules[k].priority, m.start(), m.end(), k) for k in open_ for m in self.search[k](padded)]
        kept = suppress(found)
        # characters to words: blanks before
        numbers, word, at = {}, 0, 0
        for x in sorted({*(p for p, _ in places), *(y for d in kept for y in d[1:3])}):
            word += padded.count(" ", at, x)
            at, numbers[x] = x, word
        starts = [numbers[p] for p, _ in places]
        weights = {self.base[k][1]: BASE_WEIGHT for _, k in places}
        base_labels = sorted(weights)
        for _, _, _, k in kept:
            weights[self.rules[k].label] = max(weights.get(self.rules[k].label, 0.0), self.rules[k].weight)
        rest = 1.0
        for label in sorted(weights):
            rest *= 1 - weights[label]
        return {
            "n_words": len(words), "n_base": len(places), "first_word": min(starts, default=None), "last_word": max(starts, default=None),
            "base_labels": ",".join(base_labels), "labels": ",".join(sorted(weights)), "score": 1 - rest if weights else 0.0,
            "detections": [{"label": self.rules[k].label, "first": numbers[a], "last": numbers[b] - 1, "weight": self.rules[k].weight} for _, a, b, k in kept],
        }


_KINDS = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "detections": pa.list_(pa.struct({"label": pa.string(), "first": pa.int64(), "last": pa.int64(), "weight": pa.float64()}))}


def scan_licenses(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", signatures: tuple[Rule, ...] | None = None, base: dict[str, str] = BASE) -> DataFrame:
    """One row for each document: doc_id, n_words, places of the base phrases, labels, detections.

    ``signatures``: rules in order; by default ``license_rules.rules()``. ``score`` is one
    less the product of what is left of one by the largest weight of each label. Detections
    tell their first and last word. Null texts are empty: no words, places null, score zero.
    Long texts are scanned whole; repeated rows and ids give a row each; other columns are
    ignored; an empty table gives an empty result.
    """
    of = rules() if signatures is None else tuple(signatures)

    def per_batch(batches):
        scanner = Scanner(of, base)
        for t in batches:
            buf, off = utf8(t["text"])
            found = [scanner.scan(buf[a:b].tobytes()) for a, b in zip(off[:-1], off[1:])]
            columns = [t["doc_id"], *(pa.array([x[c] for x in found], kind) for c, kind in _KINDS.items())]
            yield pa.RecordBatch.from_arrays(columns, names=["doc_id", *_KINDS])
        trim()

    rows = docs.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"))
    schema = "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, detections array<struct<label:string,first:long,last:long,weight:double>>"
    return rows.mapInArrow(per_batch, schema)
