"""Signature rules of licences: what they are called, tagged and worded like.

All patterns are over a text's lower-cased words with one blank between them, so case,
punctuation and line breaks are no part of them: "2.0" is ``2 0``, "BSD-3-Clause" is
``bsd 3 clause``. Rules come in order of priority: wording of a licence's own text, tags,
grants that name a licence, names with a version, names, abbreviations, weak hints. A rule's
keyword is the longest text that every match of it contains.

Rules that differ by a name, a version or an operator only are made from one line.
"""

from __future__ import annotations

import re
from dataclasses import dataclass


@dataclass(frozen=True)
class Rule:
    """``label`` and ``weight`` (0 to 1) of what ``pattern`` finds; the lowest ``priority`` prevails."""

    label: str
    pattern: str
    keyword: str
    priority: int
    weight: float


#: label: (names with a version, names alone). V stands for "version" in any spelling.
FAMILIES = {
    "gpl-1.0": (("gnu general public license V1(?: 0)?", "gnu gpl V1(?: 0)?", "gpl V1(?: 0)?", "gplv1"), ()),
    "gpl-2.0": (("gnu general public license V2(?: 0)?", "gnu gpl V2(?: 0)?", "gpl V2(?: 0)?", "gplv2"), ()),
    "gpl-3.0": (("gnu general public license V3(?: 0)?", "gnu gpl V3(?: 0)?", "gpl V3(?: 0)?", "gplv3"), ()),
    "gpl": ((), ("gnu general public licen[cs]e", "gnu gpl", "general public licen[cs]e")),
    "lgpl-2.0": (("gnu library general public license V2(?: 0)?", "lgpl V2 0", "lgplv2"), ()),
    "lgpl-2.1": (("gnu lesser general public license V2 1", "gnu lgpl V2 1", "lgpl V2 1", "lgplv2 1"), ()),
    "lgpl-3.0": (("gnu lesser general public license V3(?: 0)?", "gnu lgpl V3(?: 0)?", "lgpl V3(?: 0)?", "lgplv3"), ()),
    "lgpl": ((), ("gnu (?:lesser|library) general public licen[cs]e", "(?:lesser|library) general public licen[cs]e", "gnu lgpl")),
    "agpl-3.0": (("gnu affero general public license V3(?: 0)?", "gnu agpl V3(?: 0)?", "agpl V3(?: 0)?", "agplv3"), ()),
    "agpl": ((), ("gnu affero general public licen[cs]e", "affero general public licen[cs]e", "gnu agpl")),
    "gfdl-1.1": (("gnu free documentation license V1 1",), ()),
    "gfdl-1.2": (("gnu free documentation license V1 2",), ()),
    "gfdl-1.3": (("gnu free documentation license V1 3", "gfdl V1 3"), ()),
    "gfdl": ((), ("gnu free documentation licen[cs]e", "gnu fdl")),
    "apache-1.0": (("apache (?:software )?license V1 0",), ()),
    "apache-1.1": (("apache (?:software )?license V1 1",), ()),
    "apache-2.0": (("apache (?:software )?license V2(?: 0)?", "apache 2 0 license", "asl V2 0"), ()),
    "apache": ((), ("apache (?:software )?licen[cs]e",)),
    "mit": ((), ("mit licen[cs]e", "expat licen[cs]e", "mit expat licen[cs]e", "mit x11 licen[cs]e")),
    "mit-0": ((), ("mit no attribution(?: license)?", "mit 0 license")),
    "x11": ((), ("x11 licen[cs]e", "x consortium licen[cs]e")),
    "bsd-2-clause": (("bsd 2 clause(?: license)?", "2 clause bsd(?: license)?", "two clause bsd(?: license)?", "simplified bsd license", "freebsd license"), ()),
    "bsd-3-clause": (("bsd 3 clause(?: license)?", "3 clause bsd(?: license)?", "three clause bsd(?: license)?", "(?:new|modified|revised) bsd license"), ()),
    "bsd-4-clause": (("bsd 4 clause(?: license)?", "4 clause bsd(?: license)?", "four clause bsd(?: license)?", "(?:original|old) bsd license"), ()),
    "0bsd": (("zero clause bsd(?: license)?", "bsd zero clause(?: license)?", "0bsd(?: license)?"), ()),
    "bsd": ((), ("bsd (?:style )?licen[cs]e",)),
    "isc": ((), ("isc licen[cs]e", "internet systems consortium licen[cs]e")),
    "mpl-1.0": (("mozilla public license V1 0", "mpl V1 0"), ()),
    "mpl-1.1": (("mozilla public license V1 1", "mpl V1 1"), ()),
    "mpl-2.0": (("mozilla public license V2(?: 0)?", "mpl V2 0"), ()),
    "mpl": ((), ("mozilla public licen[cs]e",)),
    "epl-1.0": (("eclipse public license V1(?: 0)?", "epl V1 0"), ()),
    "epl-2.0": (("eclipse public license V2(?: 0)?", "epl V2 0"), ()),
    "epl": ((), ("eclipse public licen[cs]e",)),
    "edl-1.0": ((), ("eclipse distribution licen[cs]e",)),
    "cddl-1.0": (("common development and distribution license V1 0", "cddl V1 0"), ()),
    "cddl-1.1": (("common development and distribution license V1 1", "cddl V1 1"), ()),
    "cddl": ((), ("common development and distribution licen[cs]e", "cddl licen[cs]e")),
    "cpl-1.0": ((), ("common public licen[cs]e",)),
    "cpal-1.0": ((), ("common public attribution licen[cs]e",)),
    "eupl-1.1": (("european union public licen[cs]e V1 1", "eupl V1 1"), ()),
    "eupl-1.2": (("european union public licen[cs]e V1 2", "eupl V1 2"), ()),
    "eupl": ((), ("european union public licen[cs]e",)),
    "ms-pl": ((), ("microsoft public licen[cs]e", "ms pl licen[cs]e")),
    "ms-rl": ((), ("microsoft reciprocal licen[cs]e",)),
    "osl-3.0": (("open software license V3 0",), ()),
    "osl": ((), ("open software licen[cs]e",)),
    "afl-3.0": (("academic free license V3 0",), ()),
    "afl": ((), ("academic free licen[cs]e",)),
    "artistic-1.0": (("artistic license V1 0",), ()),
    "artistic-2.0": (("artistic license V2(?: 0)?",), ()),
    "artistic": ((), ("artistic licen[cs]e", "perl artistic licen[cs]e")),
    "bsl-1.0": (("boost software license V1 0",), ("boost software licen[cs]e",)),
    "busl-1.1": (("business source license V1 1",), ("business source licen[cs]e",)),
    "sspl-1.0": ((), ("server side public licen[cs]e",)),
    "elastic-2.0": (("elastic license V2(?: 0)?",), ("elastic licen[cs]e",)),
    "zlib": ((), ("zlib licen[cs]e", "zlib libpng licen[cs]e")),
    "libpng": ((), ("libpng licen[cs]e", "png reference library licen[cs]e")),
    "unlicense": ((), ("the unlicense", "unlicense license")),
    "wtfpl": ((), ("do what the fuck you want to public licen[cs]e", "wtfpl")),
    "psf-2.0": (("python software foundation license V2",), ("python software foundation licen[cs]e", "psf licen[cs]e")),
    "php-3.01": (("php license V3 01",), ("php licen[cs]e",)),
    "ruby": ((), ("ruby licen[cs]e", "ruby s licen[cs]e")),
    "postgresql": ((), ("postgresql licen[cs]e",)),
    "openssl": ((), ("openssl licen[cs]e", "original ssleay licen[cs]e")),
    "ofl-1.1": (("sil open font license V1 1",), ("sil open font licen[cs]e", "open font licen[cs]e")),
    "lppl-1.3c": (("latex project public license V1 3c?",), ("latex project public licen[cs]e",)),
    "vim": ((), ("vim licen[cs]e",)),
    "ncsa": ((), ("university of illinois ncsa open source licen[cs]e", "ncsa open source licen[cs]e")),
    "upl-1.0": ((), ("universal permissive licen[cs]e",)),
    "blueoak-1.0.0": ((), ("blue oak model licen[cs]e",)),
    "cecill-2.1": (("cecill license V2 1",), ("cecill licen[cs]e", "cecill free software license agreement")),
    "apsl-2.0": (("apple public source license V2 0",), ("apple public source licen[cs]e",)),
    "qpl-1.0": ((), ("q public licen[cs]e",)),
    "ipl-1.0": ((), ("ibm public licen[cs]e",)),
    "odbl-1.0": (("open database license V1 0",), ("open database licen[cs]e", "odbl licen[cs]e")),
    "odc-by-1.0": ((), ("open data commons attribution licen[cs]e", "odc by license")),
    "pddl-1.0": ((), ("public domain dedication and licen[cs]e",)),
    "cdla-permissive": ((), ("community data licen[cs]e agreement permissive",)),
    "cdla-sharing": ((), ("community data licen[cs]e agreement sharing",)),
    "ogl-uk-3.0": ((), ("open government licen[cs]e",)),
    "openrail": ((), ("creativeml open rail m(?: license)?", "bigscience open rail m(?: license)?", "open rail m licen[cs]e")),
    "llama": ((), ("llama (?:2|3|3 1|3 2) community license", "llama community licen[cs]e")),
    "hippocratic": ((), ("hippocratic licen[cs]e",)),
    "json": ((), ("json licen[cs]e",)),
    "beerware": ((), ("beerware licen[cs]e", "beer ware licen[cs]e")),
}

#: Creative Commons: elements of the label, and what they are called.
COMMONS = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nc": "attribution non ?commercial", "by-nd": "attribution no ?deriv(?:ative)?s?(?: works)?", "by-nc-sa": "attribution non ?commercial share ?alike", "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s?(?: works)?"}
COMMONS_VERSIONS = ("1 0", "2 0", "2 5", "3 0", "4 0")

#: Wording of licences' own texts: label, pattern.
WORDING = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("bsd-3-clause", "neither the name of (?:[^ ]+ ){1,12}nor the names of its contributors may be used to endorse or promote products"),
    ("bsd-4-clause", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("apache-2.0", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    ("apache-2.0", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "apache license version 2 0 january 2004"),
    ("gpl-2.0-or-later", "either version 2 of the license or at your option any later version"),
    ("gpl-3.0-or-later", "either version 3 of the license or at your option any later version"),
    ("lgpl-2.1-or-later", "either version 2 1 of the license or at your option any later version"),
    ("gpl-2.0", "gnu general public license version 2 june 1991"),
    ("gpl-3.0", "gnu general public license version 3 29 june 2007"),
    ("lgpl-3.0", "gnu lesser general public license version 3 29 june 2007"),
    ("agpl-3.0", "gnu affero general public license version 3 19 november 2007"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license"),
    ("lgpl", "this library is free software you can redistribute it and or modify it under the terms of the gnu (?:lesser|library) general public license"),
    ("agpl", "redistribute it and or modify it under the terms of the gnu affero general public license"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("mpl-1.1", "the contents of this file are subject to the mozilla public license version 1 1"),
    ("cddl-1.0", "the contents of this file are subject to the terms of the common development and distribution license"),
    ("epl-1.0", "accompanying materials are made available under the terms of the eclipse public license v1 0"),
    ("epl-2.0", "accompanying materials are made available under the terms of the eclipse public license 2 0"),
    ("bsl-1.0", "distributed under the boost software license version 1 0"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable"),
    ("unlicense", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "you just do what the fuck you want to"),
    ("ofl-1.1", "this font software is licensed under the sil open font license version 1 1"),
    ("psf-2.0", "python software foundation license version 2 psf license agreement"),
    ("postgresql", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and without a written agreement is hereby granted"),
    ("ncsa", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal with the software"),
    ("openssl", "this product includes software developed by the openssl project for use in the openssl toolkit"),
    ("json", "the software shall be used for good not evil"),
    ("beerware", "as long as you retain this notice you can do whatever you want with this stuff"),
    ("cc0-1.0", "to the extent possible under law (?:[^ ]+ ){1,12}waived all copyright and related or neighboring rights"),
    ("gfdl", "permission is granted to copy distribute and or modify this document under the terms of the gnu free documentation license"),
    ("ms-pl", "if you use the software you accept this license if you do not accept the license do not use the software"),
    ("artistic", "you may distribute this package under the terms of either the gnu general public license or the artistic license"),
    ("perl", "this (?:library|program|module) is free software you can redistribute it and or modify it under the same terms as perl"),
    ("upl-1.0", "subject to the condition set forth below permission is hereby granted to any person obtaining a copy of this software associated documentation and or data"),
)

#: Weak hints: label, pattern.
HINTS = (
    ("public-domain", "(?:released|placed|dedicated) (?:in|into|to) the public domain"),
    ("public-domain", "public domain"),
    ("proprietary", "all rights reserved"),
    ("proprietary", "proprietary and confidential"),
    ("proprietary", "confidential and proprietary"),
    ("proprietary", "unauthori[sz]ed (?:copying|reproduction|distribution)(?: [^ ]+){0,8} (?:strictly )?prohibited"),
    ("proprietary", "may not be (?:reproduced|copied|distributed)(?: [^ ]+){0,12} without (?:the )?(?:prior )?(?:written )?permission"),
    ("commercial", "commercial licen[cs]e"),
    ("copyright-notice", "copyright c (?:19|20)[0-9]{2}"),
    ("copyright-notice", "copyright (?:19|20)[0-9]{2}"),
    ("other-permissive", "permissive (?:open source )?licen[cs]e"),
    ("other-copyleft", "copyleft licen[cs]e"),
    ("non-commercial", "(?:for )?non ?commercial use only"),
    ("research-only", "for (?:academic|research) (?:and research )?(?:use|purposes) only"),
    ("no-ai-training", "may not be used (?:to train|for training)(?: [^ ]+){0,6} (?:models?|systems?|intelligence)"),
    ("see-license-file", "see (?:the )?(?:license|licence|copying)(?: txt| md)? (?:file )?for (?:details|more information|the full license)"),
    ("dual-licensed", "(?:dual|multi) licensed"),
    ("under-license-of", "licensed under (?:the )?same (?:terms|license)"),
)

_VERSION = "(?:version |v ?|ver )?"


def keyword(pattern: str) -> str:
    """The longest run of plain characters that every match of a pattern contains."""
    runs, depth, k = [""], 0, 0
    while k < len(pattern):
        c = pattern[k]
        if c == "[":
            k = pattern.index("]", k)
        depth += (c == "(") - (c == ")")
        if depth == 0 and (c.isalnum() or c == " ") and pattern[k + 1 : k + 2] not in ("?", "{", "*"):
            runs[-1] += c
        else:
            runs.append("")
        if c == "{":
            k = pattern.index("}", k)
        k += 1
    return max(runs, key=len)


def rules() -> tuple[Rule, ...]:
    """All rules, highest priority first."""
    out: list[Rule] = []
    add = lambda label, pattern, priority, weight: out.append(Rule(label, pattern, keyword(pattern), priority, weight))
    for label, pattern in WORDING:
        add(label, pattern, 0, 0.98)
    tags = [*(x for x in FAMILIES if re.search(r"\d$|^(mit|isc|zlib|x11|vim|ruby|unlicense|postgresql|ncsa|wtfpl|ms-..)$", x)), "cc0-1.0", *(f"cc-{x}-{v.replace(' ', '.')}" for x in COMMONS for v in COMMONS_VERSIONS)]
    for label in tags:
        written = re.escape(re.sub(r"[^a-z0-9]", " ", label)).replace(r"\ ", " ")
        add(label, f"spdx license identifier {written}", 1, 0.97)
        if re.match(r"(?:a|l)?gpl-\d|gfdl-\d", label):
            add(f"{label}-only", f"spdx license identifier {written} only", 1, 0.97)
            add(f"{label}-or-later", f"spdx license identifier {written} or later", 1, 0.97)
    for label, (versioned, named) in FAMILIES.items():
        for name in versioned:
            name = name.replace("V", _VERSION).replace("license", "licen[cs]e")
            add(label, name, 3, 0.9)
            if re.match(r"(?:a|l)?gpl-\d", label):
                add(f"{label}-or-later", f"{name} (?:or(?: at your option)? (?:any )?(?:later|newer)(?: version)?|or above)", 2, 0.95)
                add(f"{label}-only", f"{name} only", 2, 0.95)
        for name in named:
            add(label, name, 4, 0.75)
    for elements, words in COMMONS.items():
        short = elements.replace("-", " ")
        for version in COMMONS_VERSIONS:
            label = f"cc-{elements}-{version.replace(' ', '.')}"
            add(label, f"creative commons {words} {version}(?: international| unported| generic)?(?: (?:public )?licen[cs]e)?", 2, 0.95)
            add(label, f"cc {short} {version}", 3, 0.9)
        add(f"cc-{elements}", f"creative commons {words}(?: licen[cs]e)?", 4, 0.75)
        add(f"cc-{elements}", f"cc {short}", 5, 0.6)
    add("cc0-1.0", "cc0 1 0(?: universal)?", 3, 0.9)
    add("cc0-1.0", "creative commons (?:cc0|zero)(?: 1 0)?", 2, 0.95)
    add("cc0-1.0", "cc0", 5, 0.6)
    add("creative-commons", "creative commons(?: licen[cs]e)?", 6, 0.4)
    for label, pattern in HINTS:
        add(label, pattern, 7, 0.3)
    return tuple(sorted(out, key=lambda r: r.priority))
