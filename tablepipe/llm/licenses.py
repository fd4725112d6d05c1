"""License scan by ordered signature rules (operator 2).

Rules are regular expressions with a label, a priority and keywords, derived from
the expressions themselves.  One Aho-Corasick pass finds the keywords that occur
and only rules with all keywords of an alternative run, in priority order.  A
space of a rule stands for a run of white space, over line ends also with the
comment marks around them.  A
detection that lies inside an accepted one is suppressed (of equal spans the
rule of higher priority, then the earlier rule, stays).

The base phrases (an exact word-sequence search) are reported beside the rules'
labels and are never suppressed.

Matching works on the UTF-8 bytes with A-Z lower-cased, read as Latin-1, so
offsets are byte offsets.  Words are runs of a-z, 0-9 and non-ASCII bytes.

Defined results: null or empty text has no words, no labels and score 0;
repeated rows are scanned on their own; other columns are ignored.
"""

from __future__ import annotations

import re
from bisect import bisect_right, insort
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

WORD = r"[0-9a-z\x80-\xff]"
GAP = r"[\x00-\x2f\x3a-\x60\x7b-\x7f]+"
BASE = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

# label: (names, SPDX ids, URL parts), written by hand; each part is a regular expression.
FAMILIES = {
    "mit": (r"mit license|mit licen[cs]e|expat license|license :: osi approved :: mit", r"mit(?:-0|-advertising|-cmu|-feh|-modern-variant)?", r"opensource\.org/licenses?/mit|mit-license\.org"),
    "apache": (r"apache license(?:, version)? ?2(?:\.0)?|apache software license|asl 2\.0|apache-2(?:\.0)? license", r"apache-(?:1\.0|1\.1|2\.0)", r"apache\.org/licenses?/license-(?:1\.[01]|2\.0)"),
    "gpl": (r"gnu general public licen[cs]e|gnu gpl|gpl ?v?[123](?:\.0)?\+?|general public licen[cs]e v(?:ersion )?[123]", r"gpl-[123]\.0(?:-only|-or-later|\+)?", r"gnu\.org/(?:licenses|copyleft)/gpl"),
    "lgpl": (r"gnu lesser general public licen[cs]e|gnu library general public licen[cs]e|lgpl ?v?(?:2|2\.1|3)(?:\.0)?\+?", r"lgpl-(?:2\.0|2\.1|3\.0)(?:-only|-or-later|\+)?", r"gnu\.org/(?:licenses|copyleft)/(?:lesser|lgpl)"),
    "agpl": (r"gnu affero general public licen[cs]e|affero gpl|agpl ?v?[13](?:\.0)?", r"agpl-[13]\.0(?:-only|-or-later|\+)?", r"gnu\.org/licenses/agpl"),
    "gfdl": (r"gnu free documentation licen[cs]e|gfdl ?v?1\.[123]", r"gfdl-1\.[123](?:-only|-or-later)?", r"gnu\.org/(?:licenses|copyleft)/fdl"),
    "bsd-2-clause": (r"2-clause bsd licen[cs]e|simplified bsd licen[cs]e|freebsd licen[cs]e|bsd 2-clause", r"bsd-2-clause(?:-patent|-views)?", r"opensource\.org/licenses?/bsd-2-clause"),
    "bsd-3-clause": (r"3-clause bsd licen[cs]e|new bsd licen[cs]e|modified bsd licen[cs]e|bsd 3-clause|revised bsd licen[cs]e", r"bsd-3-clause(?:-clear|-lbnl)?", r"opensource\.org/licenses?/bsd-3-clause"),
    "bsd-4-clause": (r"4-clause bsd licen[cs]e|original bsd licen[cs]e|bsd 4-clause", r"bsd-4-clause(?:-uc)?", r"spdx\.org/licenses/bsd-4-clause"),
    "0bsd": (r"zero[- ]clause bsd|bsd zero clause licen[cs]e", r"0bsd", r"opensource\.org/licenses?/0bsd"),
    "isc": (r"isc licen[cs]e|internet systems consortium licen[cs]e", r"isc", r"opensource\.org/licenses?/isc"),
    "mpl": (r"mozilla public licen[cs]e|mpl ?v?(?:1\.0|1\.1|2\.0)", r"mpl-(?:1\.0|1\.1|2\.0)(?:-no-copyleft-exception)?", r"mozilla\.org/(?:en-us/)?mpl"),
    "epl": (r"eclipse public licen[cs]e|epl ?v?[12]\.0", r"epl-[12]\.0", r"eclipse\.org/(?:legal/epl|org/documents/epl)"),
    "edl": (r"eclipse distribution licen[cs]e|edl ?v?1\.0", r"edl-1\.0", r"eclipse\.org/org/documents/edl"),
    "cddl": (r"common development and distribution licen[cs]e|cddl ?v?1\.[01]", r"cddl-1\.[01]", r"opensource\.org/licenses?/cddl"),
    "cpl": (r"common public licen[cs]e|ibm public licen[cs]e", r"(?:cpl|ipl)-1\.0", r"opensource\.org/licenses?/cpl1"),
    "cpal": (r"common public attribution licen[cs]e", r"cpal-1\.0", r"opensource\.org/licenses?/cpal"),
    "eupl": (r"european union public licen[cs]e|eupl ?v?1\.[012]", r"eupl-1\.[012]", r"joinup\.ec\.europa\.eu/(?:software|collection)/(?:page/)?eupl"),
    "cecill": (r"cecill(?:-[bc])? free software licen[cs]e|cecill licen[cs]e", r"cecill-(?:1\.[01]|2\.[01]|b|c)", r"cecill\.info/licences"),
    "artistic": (r"artistic licen[cs]e|perl artistic", r"artistic-(?:1\.0|2\.0)(?:-perl|-cl8)?", r"opensource\.org/licenses?/artistic|perlfoundation\.org/artistic"),
    "boost": (r"boost software licen[cs]e|bsl-1\.0 licen[cs]e", r"bsl-1\.0", r"boost\.org/license"),
    "busl": (r"business source licen[cs]e", r"busl-1\.1", r"mariadb\.com/bsl"),
    "zlib": (r"zlib licen[cs]e|zlib/libpng licen[cs]e", r"zlib(?:-acknowledgement)?", r"zlib\.net/zlib_license|opensource\.org/licenses?/zlib"),
    "libpng": (r"libpng licen[cs]e|png reference library licen[cs]e", r"libpng(?:-2\.0)?", r"libpng\.org/pub/png/src/libpng-license"),
    "unlicense": (r"the unlicense|unlicense yourself", r"unlicense", r"unlicense\.org"),
    "wtfpl": (r"do what the fuck you want to public licen[cs]e|wtfpl", r"wtfpl", r"wtfpl\.net|sam\.zoy\.org/wtfpl"),
    "cc0": (r"cc0 1\.0 universal|creative commons zero|cc0 public domain", r"cc0-1\.0", r"creativecommons\.org/publicdomain/zero"),
    "cc-by": (r"creative commons attribution (?:[1-4]\.[05] )?(?:international |unported |generic )?licen[cs]e|cc[- ]by[- ][1-4]\.[05]", r"cc-by-[1-4]\.[05]", r"creativecommons\.org/licenses/by/"),
    "cc-by-sa": (r"creative commons attribution-share ?alike|cc[- ]by-sa(?:[- ][1-4]\.[05])?", r"cc-by-sa-[1-4]\.[05]", r"creativecommons\.org/licenses/by-sa"),
    "cc-by-nc": (r"creative commons attribution-non-?commercial|cc[- ]by-nc(?:[- ][1-4]\.[05])?", r"cc-by-nc-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nc/"),
    "cc-by-nd": (r"creative commons attribution-no ?deriv(?:ative)?s|cc[- ]by-nd(?:[- ][1-4]\.[05])?", r"cc-by-nd-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nd"),
    "cc-by-nc-sa": (r"attribution-non-?commercial-share ?alike|cc[- ]by-nc-sa", r"cc-by-nc-sa-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nc-sa"),
    "cc-by-nc-nd": (r"attribution-non-?commercial-no ?deriv(?:ative)?s|cc[- ]by-nc-nd", r"cc-by-nc-nd-[1-4]\.[05]", r"creativecommons\.org/licenses/by-nc-nd"),
    "public-domain": (r"released into the public domain|dedicated to the public domain|public domain dedication", r"pddl-1\.0", r"creativecommons\.org/(?:publicdomain/mark|licenses/publicdomain)"),
    "odbl": (r"open database licen[cs]e|odbl ?v?1\.0", r"odbl-1\.0", r"opendatacommons\.org/licenses/odbl"),
    "odc-by": (r"open data commons attribution licen[cs]e", r"odc-by-1\.0", r"opendatacommons\.org/licenses/by"),
    "ofl": (r"sil open font licen[cs]e|open font licen[cs]e|ofl ?v?1\.[01]", r"ofl-1\.[01](?:-rfn|-no-rfn)?", r"scripts\.sil\.org/ofl|openfontlicense\.org"),
    "ubuntu-font": (r"ubuntu font licen[cs]e", r"ubuntu-font-1\.0", r"font\.ubuntu\.com/ufl"),
    "ms-pl": (r"microsoft public licen[cs]e|ms-pl licen[cs]e", r"ms-pl", r"opensource\.org/licenses?/ms-pl"),
    "ms-rl": (r"microsoft reciprocal licen[cs]e|ms-rl licen[cs]e", r"ms-rl", r"opensource\.org/licenses?/ms-rl"),
    "python": (r"python software foundation licen[cs]e|psf licen[cs]e", r"(?:psf|python)-2\.0(?:\.1)?", r"docs\.python\.org/[0-9./]*license"),
    "php": (r"php licen[cs]e,? version|the php licen[cs]e", r"php-3\.0?1?", r"php\.net/license"),
    "ruby": (r"the ruby licen[cs]e|ruby's licen[cs]e", r"ruby", r"ruby-lang\.org/en/about/license"),
    "openssl": (r"openssl licen[cs]e|openssl/ssleay", r"openssl", r"openssl\.org/source/license"),
    "curl": (r"curl licen[cs]e|curl and libcurl are", r"curl", r"curl\.se/docs/copyright"),
    "postgresql": (r"postgresql licen[cs]e", r"postgresql", r"postgresql\.org/about/licen[cs]e"),
    "w3c": (r"w3c software (?:and document )?(?:notice and )?licen[cs]e", r"w3c(?:-19980720|-20150513)?", r"w3\.org/consortium/legal"),
    "vim": (r"vim licen[cs]e", r"vim", r"vimhelp\.org/uganda"),
    "x11": (r"x11 licen[cs]e|x consortium licen[cs]e", r"x11(?:-distribute-modifications-variant)?", r"xfree86\.org/[0-9.]*/?license"),
    "ncsa": (r"university of illinois/ncsa open source licen[cs]e|ncsa licen[cs]e", r"ncsa", r"opensource\.org/licenses?/ncsa"),
    "llvm-exception": (r"apache licen[cs]e v2\.0 with llvm exceptions?", r"apache-2\.0 with llvm-exception", r"llvm\.org/license"),
    "classpath": (r"classpath exception", r"gpl-2\.0(?:-only|-or-later)? with classpath-exception-2\.0", r"gnu\.org/software/classpath/license"),
    "osl": (r"open software licen[cs]e", r"osl-[123]\.[01]", r"opensource\.org/licenses?/osl"),
    "afl": (r"academic free licen[cs]e", r"afl-(?:1\.[12]|2\.[01]|3\.0)", r"opensource\.org/licenses?/afl"),
    "sspl": (r"server side public licen[cs]e", r"sspl-1\.0", r"mongodb\.com/licensing/server-side"),
    "elastic": (r"elastic licen[cs]e(?: 2\.0)?", r"elastic-2\.0", r"elastic\.co/licensing/elastic"),
    "commons-clause": (r"commons clause licen[cs]e condition", r"commons-clause", r"commonsclause\.com"),
    "polyform": (r"polyform (?:noncommercial|small business|strict|shield|perimeter) licen[cs]e", r"polyform-(?:noncommercial|small-business)-1\.0\.0", r"polyformproject\.org/licenses"),
    "hippocratic": (r"hippocratic licen[cs]e", r"hippocratic-2\.1", r"firstdonoharm\.dev"),
    "json": (r"the json licen[cs]e|shall be used for good, not evil", r"json", r"json\.org/license"),
    "beerware": (r"the beer-?ware licen[cs]e", r"beerware", r"people\.freebsd\.org/~phk"),
    "upl": (r"universal permissive licen[cs]e", r"upl-1\.0", r"oss\.oracle\.com/licenses/upl"),
    "mulan": (r"mulan p(?:ermissive software|sl) licen[cs]e|mulan psl", r"mulanpsl-[12]\.0", r"license\.coscl\.org\.cn/mulanpsl"),
    "naist": (r"nara institute of science and technology licen[cs]e", r"naist-2003", r"naist\.jp/[a-z/]*license"),
    "unicode": (r"unicode licen[cs]e|unicode,? inc\.? licen[cs]e agreement", r"unicode-(?:dfs-201[56]|3\.0|tou)", r"unicode\.org/(?:copyright|license)"),
    "ijg": (r"independent jpeg group licen[cs]e|work of the independent jpeg group", r"ijg", r"ijg\.org/files/readme"),
    "sleepycat": (r"sleepycat licen[cs]e", r"sleepycat", r"opensource\.org/licenses?/sleepycat"),
    "qpl": (r"q public licen[cs]e", r"qpl-1\.0", r"doc\.qt\.io/archives/[0-9./]*license"),
    "lppl": (r"latex project public licen[cs]e", r"lppl-1\.[0123][ac]?", r"latex-project\.org/lppl"),
    "nasa": (r"nasa open source agreement", r"nasa-1\.3", r"opensource\.org/licenses?/nasa"),
    "blueoak": (r"blue oak model licen[cs]e", r"blueoak-1\.0\.0", r"blueoakcouncil\.org/license"),
    "openrail": (r"openrail(?:-m|\+\+)? licen[cs]e|responsible ai licen[cs]e", r"(?:bigscience-)?openrail(?:-m)?", r"licenses\.ai|bigscience\.huggingface\.co/blog/the-bigscience-rail"),
    "proprietary": (r"all rights reserved|proprietary and confidential|confidential and proprietary", r"licenseref-(?:proprietary|commercial)", r"example-vendor\.invalid/eula"),
}
# label, regular expression: sentences of the licence bodies.
BODIES = (
    ("mit", r"permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation"),
    ("mit", r"the above copyright notice and this permission notice shall be included in all copies"),
    ("mit", r"without restriction, including without limitation the rights to use, copy, modify, merge, publish"),
    ("apache", r"you may not use this file except in compliance with the license"),
    ("apache", r'distributed on an "as is" basis, without warranties or conditions of any kind'),
    ("apache", r"terms and conditions for use, reproduction, and distribution"),
    ("apache", r"grant of patent license\. subject to the terms and conditions"),
    ("gpl", r"this program is free software[:;] you can redistribute it and/or modify"),
    ("gpl", r"you should have received a copy of the gnu general public license"),
    ("gpl", r"everyone is permitted to copy and distribute verbatim copies"),
    ("gpl", r"either version [123] of the license, or \(at your option\) any later version"),
    ("lgpl", r"this library is free software[:;] you can redistribute it and/or modify"),
    ("lgpl", r"you should have received a copy of the gnu lesser general public license"),
    ("agpl", r"you should have received a copy of the gnu affero general public license"),
    ("agpl", r"remote network interaction; use with the gnu general public license"),
    ("bsd-2-clause", r"redistributions of source code must retain the above copyright notice"),
    ("bsd-2-clause", r"redistributions in binary form must reproduce the above copyright notice"),
    ("bsd-3-clause", r"may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", r"all advertising materials mentioning features or use of this software must display"),
    ("isc", r"permission to use, copy, modify, and/or distribute this software for any purpose with or without fee"),
    ("mpl", r"this source code form is subject to the terms of the mozilla public license"),
    ("mpl", r"if a copy of the mpl was not distributed with this file"),
    ("epl", r"this program and the accompanying materials are made available under the terms of the eclipse"),
    ("zlib", r"altered source versions must be plainly marked as such"),
    ("zlib", r"the origin of this software must not be misrepresented"),
    ("unlicense", r"this is free and unencumbered software released into the public domain"),
    ("wtfpl", r"you just do what the fuck you want to"),
    ("boost", r"permission is hereby granted, free of charge, to any person or organization obtaining a copy of the software"),
    ("ofl", r"this font software is licensed under the sil open font license"),
    ("artistic", r"the intent of this document is to state the conditions under which a package may be copied"),
    ("python", r"psf hereby grants licensee a nonexclusive, royalty-free, world-wide license"),
    ("cc0", r"the person who associated a work with this deed has dedicated the work to the public domain"),
    ("cc-by", r"you must give appropriate credit, provide a link to the license, and indicate if changes were made"),
    ("cc-by-sa", r"if you remix, transform, or build upon the material, you must distribute your contributions under the same license"),
    ("cc-by-nc", r"you may not use the material for commercial purposes"),
    ("beerware", r"as long as you retain this notice you can do whatever you want with this stuff"),
    ("w3c", r"permission to copy, modify, and distribute this software and its documentation, with or without modification"),
    ("gfdl", r"permission is granted to copy, distribute and/or modify this document under the terms of the gnu free documentation license"),
    ("eupl", r"licensed under the eupl, version 1\.[012]"),
    ("proprietary", r"unauthorized copying of this file, via any medium,? is strictly prohibited"),
)
# What a space of a rule matches: white space, over a line end with comment marks before and after it.
BLANK = r"(?:[\t-\r ]|\xc2\xa0)"
MARK = r"[#*/;%>!|-]"
SPACE = rf"""(?:{BLANK}++(?!{MARK}|["'](?=[ \t])|(?:rem|dnl)[ \t])|(?:[ \t]++{MARK}*+[ \t]*+)?+[\r\n](?:{BLANK}|{MARK}|(?<=[\r\n\t ])["'](?=[ \t])|(?<=[\r\n])(?:rem|dnl)(?=[ \t\r\n]))*+|{BLANK}++)"""
# kind: (priority, confidence, shape around the pattern)
KINDS = {
    "spdx": (4, 1.0, r"spdx-license-identifier:\s*(?:{0})(?![0-9a-z.+-])"),
    "body": (3, 0.95, r"{0}"),
    "under": (2, 0.9, r"(?:licen[cs]ed|released|distributed|available|provided) under (?:the )?(?:terms of (?:the )?)?(?:{0})(?![0-9a-z])"),
    "url": (2, 0.85, r"(?:https?://)?(?:www\.)?(?:{0})"),
    "name": (1, 0.7, r"(?<![0-9a-z])(?:{0})(?![0-9a-z])"),
}
# Pieces of an alternative that a text must hold before its rule runs.
KEYWORDS = 4


def spaced(pattern: str) -> str:
    """``pattern`` with each space, also as one of two characters, widened to SPACE."""
    return re.sub(r"\[- \]| ", lambda m: SPACE if m[0] == " " else f"(?:-|{SPACE})", pattern)


def keywords(pattern: str) -> list[frozenset[str]]:
    """For each top-level alternative its longest literal pieces without spaces; a
    match holds all those of one alternative."""
    out = []
    for part in _alternatives(pattern):
        bare = re.sub(r"\[[^\]]*\][+*?]?", "\0", part)
        while (bare2 := re.sub(r"\((?:\?[:=!<]+)?[^()]*\)[?*+]?", "\0", bare.replace("\\(", "\0").replace("\\)", "\0"))) != bare:
            bare = bare2
        bare = re.sub(r"\\s[*+]?|.\?|.\*|\\[dwb][+*?]?", "\0", bare.replace("\\.", "\1")).replace("\1", ".")
        pieces = {p for p in re.split("[\0 ]+", bare.replace("\\", "")) if len(p) > 1}
        if not pieces:
            raise ValueError(f"no keyword in {part}")
        out.append(frozenset(sorted(pieces, key=lambda p: (-len(p), p))[:KEYWORDS]))
    return out


def _alternatives(pattern: str) -> list[str]:
    parts, depth, start, k = [], 0, 0, 0
    while k < len(pattern):
        c = pattern[k]
        k += c == "\\"
        depth += (c in "([") - (c in ")]")
        if c == "|" and not depth:
            parts.append(pattern[start:k])
            start = k + 1
        k += 1
    return [*parts, pattern[start:]]


def rules() -> list[tuple[str, str, int, float, str, list[frozenset[str]]]]:
    """(label, kind, priority, confidence, regular expression, keywords), highest priority first."""
    out = []
    for label, (names, spdx, urls) in FAMILIES.items():
        for kind, pattern in (("spdx", spdx), ("under", names), ("url", urls), ("name", names)):
            out.append((label, kind, *KINDS[kind][:2], KINDS[kind][2].format(pattern), [frozenset(["spdx-license-identifier"])] if kind == "spdx" else keywords(pattern)))
    for label, pattern in BODIES:
        out.append((label, "body", *KINDS["body"][:2], pattern, keywords(pattern)))
    return sorted(out, key=lambda r: -r[2])


class Scanner:
    def __init__(self, base: tuple = BASE):
        import ahocorasick

        self.rules = [(label, kind, prio, conf, re.compile(spaced(rx))) for label, kind, prio, conf, rx, _ in rules()]
        self.words = ahocorasick.Automaton()
        by: dict[str, list[tuple[frozenset[str], int]]] = {}  # each alternative under its longest piece
        for k, (*_, keys) in enumerate(rules()):
            for pieces in keys:
                by.setdefault(max(pieces, key=lambda p: (len(p), p)), []).append((pieces, k))
        self.needs = by
        for key in {p for alternatives in by.values() for pieces, _ in alternatives for p in pieces}:
            self.words.add_word(key, key)
        self.words.make_automaton()
        self.base = [(phrase.split()[-1], label, re.compile(f"(?<!{WORD})" + GAP.join(map(re.escape, phrase.split())) + f"(?!{WORD})")) for phrase, label in base]
        self.is_word = np.zeros(256, bool)
        self.is_word[[*range(0x30, 0x3A), *range(0x61, 0x7B), *range(0x80, 0x100)]] = True

    def detections(self, text: str) -> list[tuple[int, int, str, str, float]]:
        """(start, end, label, kind, confidence), none inside another, by start; ``text`` lower-cased Latin-1."""
        held = {key for _, key in self.words.iter(text)}
        due = {k for key in held for pieces, k in self.needs.get(key, ()) if pieces <= held}
        found = []
        for k in sorted(due):
            label, kind, prio, conf, rx = self.rules[k]
            found += [(-prio, m.start() - m.end(), k, m.start(), m.end(), label, kind, conf) for m in rx.finditer(text)]
        kept: list[tuple[int, int]] = []  # outermost accepted spans, by start and so by end
        out = []
        for _, _, _, start, end, label, kind, conf in sorted(found):
            at = bisect_right(kept, (start, 1 << 62))
            if at and kept[at - 1][1] >= end:
                continue
            while at < len(kept) and kept[at][1] <= end:
                del kept[at]
            insort(kept, (start, end))
            out.append((start, end, label, kind, conf))
        return sorted(out)

    def scan(self, text: str | None) -> dict:
        raw = (text or "").encode("utf-8", "surrogatepass").lower()
        mask = self.is_word[np.frombuffer(raw, np.uint8)]
        starts = np.flatnonzero(mask & ~np.concatenate([[False], mask[:-1]])) if len(raw) else np.zeros(0, np.int64)
        s = raw.decode("latin-1")
        places, base = [], set()
        for last, label, rx in self.base:
            if last in s:
                hits = [m.start() for m in rx.finditer(s)]
                places += hits
                base |= {label} if hits else set()
        found = self.detections(s)
        labels = base | {f[2] for f in found}
        miss, best = 1.0, {}
        for _, _, label, _, conf in found:
            best[label] = max(best.get(label, 0.0), conf)
        for conf in best.values():
            miss *= 1 - min(conf, 0.99)
        if base:
            miss *= 0.05
        at = np.searchsorted(starts, [min(places), max(places)]) if places else (None, None)
        return {
            "n_words": len(starts), "n_base": len(places), "first_word": None if at[0] is None else int(at[0]), "last_word": None if at[1] is None else int(at[1]),
            "base_labels": ",".join(sorted(base)), "labels": ",".join(sorted(labels)), "score": 1.0 - miss if labels else 0.0,
            "spans": [{"start": a, "end": b, "label": lab, "kind": kind, "confidence": conf} for a, b, lab, kind, conf in found],
        }


_SCANNERS: dict = {}
_SPAN = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("label", pa.string()), ("kind", pa.string()), ("confidence", pa.float64())]))
_FIELDS = {"n_words": pa.int64(), "n_base": pa.int64(), "first_word": pa.int64(), "last_word": pa.int64(), "base_labels": pa.string(), "labels": pa.string(), "score": pa.float64(), "spans": _SPAN}


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", base: tuple = BASE) -> DataFrame:
    """doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score
    and spans (byte offsets of the accepted detections)."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scanner = _SCANNERS.get(base) or _SCANNERS.setdefault(base, Scanner(base))
        for batch in batches:
            for k in range(0, batch.num_rows, 512):
                some = batch.slice(k, 512)
                got = [scanner.scan(t) for t in some.column(1).to_pylist()]
                yield pa.RecordBatch.from_arrays([some.column(0), *[pa.array([g[f] for g in got], kind) for f, kind in _FIELDS.items()]], names=["doc_id", *_FIELDS])

    kind = docs.schema[id_col].dataType.simpleString()
    span = "array<struct<start: bigint, end: bigint, label: string, kind: string, confidence: double>>"
    rows = docs.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"))
    return rows.mapInArrow(run, f"doc_id {kind}, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, spans {span}")
