import random
import re

import pytest

from docpipe.llm.license_rules import rules
from docpipe.llm.license_scan import BASE, BASE_WEIGHT, scan_licenses
from docpipe.llm.queries import op12_license_scan

RULES = rules()
COMPILED = [re.compile(rf" (?:{r.pattern})(?= )") for r in RULES]


def expected(text):
    """Every rule without a prefilter, every pair of detections for containment."""
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", low)
    places = []
    for phrase, label in BASE.items():
        own = phrase.split()
        places += [(k, label) for k in range(len(words)) if words[k : k + len(own)] == own]
    padded = f" {' '.join(words)} "
    found = [(RULES[k].priority, m.start(), m.end(), k) for k, x in enumerate(COMPILED) for m in x.finditer(padded)]
    better = lambda a, b: (a[0], a[1] - a[2], a[3]) < (b[0], b[1] - b[2], b[3])
    kept = [d for d in found if not any(better(a, d) and a[1] <= d[1] and a[2] >= d[2] for a in found)]
    weights = {label: BASE_WEIGHT for _, label in places}
    base = ",".join(sorted(weights))
    for d in kept:
        weights[RULES[d[3]].label] = max(weights.get(RULES[d[3]].label, 0), RULES[d[3]].weight)
    rest = 1.0
    for label in sorted(weights):
        rest *= 1 - weights[label]
    starts = [k for k, _ in places]
    spans = sorted((padded[: d[1]].count(" "), padded[: d[2]].count(" ") - 1, RULES[d[3]].label) for d in kept)
    return (len(words), len(places), min(starts, default=None), max(starts, default=None), base, ",".join(sorted(weights)), 1 - rest if weights else 0.0), spans


TEXTS = [
    None, "", " \n", "mit", "Lizenz mit Freude", "MIT License", "the (MIT) License.", "CC BY", "cc-by-nc-sa/4.0", "CC-BY CC BY cc by", "é mit license é", "smit license", "mit licenses", "mit\nlicense apache\tlicense",
    "Licensed under the Apache License, Version 2.0.", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License.",
    "GNU General Public License, version 3 or later", "GNU GPL v2 or any later version; GPLv3 only, LGPL-2.1", "SPDX-License-Identifier: GPL-2.0-or-later", "SPDX-License-Identifier: MIT\n// SPDX-License-Identifier: BSD-3-Clause",
    "Copyright (c) 2019 A. All rights reserved. Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "Neither the name of the company nor the names of its contributors may be used to endorse or promote products", "Creative Commons Attribution-ShareAlike 4.0 International License", "CC0 1.0 Universal", "public domain",
    "GNU Affero General Public License", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the \"Software\"), to deal in the Software",
]


def check(docs, texts):
    got = {r.doc_id: r for r in scan_licenses(docs).collect()}
    assert len(got) == len(texts)
    for k, text in enumerate(texts):
        want, spans = expected(text)
        assert tuple(got[k])[1:8] == want, text
        assert sorted((d["first"], d["last"], d["label"]) for d in got[k].detections) == spans, text


def test_agrees_with_all_rules(make_docs, prose):
    rng = random.Random(1)
    texts = list(TEXTS)
    pieces = [w for t in TEXTS[3:] for w in t.split()]
    texts += [" ".join(rng.choice(pieces) for _ in range(n)) for n in (3, 10, 40, 200) for _ in range(12)]
    texts += [" ".join(rng.choice((rng.choice(TEXTS[3:]), prose(6))) for _ in range(60)) for _ in range(5)]
    texts.append(f"{prose(20_000)} MIT License {prose(20_000)} cc by {prose(10)}")
    texts.append(texts[-2])
    check(make_docs(list(enumerate(texts))), texts)


def test_each_rule_has_matches_with_its_keyword():
    assert len(RULES) > 300
    for r in RULES:
        assert len(r.keyword.strip()) >= 3, r
    samples = " ".join(f"{t} ." for t in TEXTS[3:])
    assert expected(samples)[0][5].count(",") > 15


def test_many_detections_take_linear_time(make_docs):
    import time

    text = "GNU GPL v2 or any later version. CC BY-NC 4.0. Apache License " * 20_000
    start = time.time()
    row = scan_licenses(make_docs([(1, text)])).collect()[0]
    assert row.n_base == 40_000 and len(row.detections) == 60_000
    assert time.time() - start < 60


def test_empty_table_null_ids_repeats(make_docs):
    assert scan_licenses(make_docs([])).count() == 0
    assert [r.labels for r in scan_licenses(make_docs([(None, "mit license"), (None, "mit license")])).collect()] == ["mit", "mit"]


@pytest.mark.parametrize("size", ["sf0.001"])
def test_query_agrees_with_all_rules(spark, size):
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"/root/testdata/{size}/documents.parquet").select("doc_id", "text").collect()}
    got = {r.doc_id: tuple(r)[1:] for r in op12_license_scan(spark, f"/root/testdata/{size}").collect()}
    assert got == {k: expected(t)[0] for k, t in texts.items()}
