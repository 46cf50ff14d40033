"""Operator 8: license scans by ordered signature rules.

Words are maximal runs outside ``\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F`` after A-Z are
lower-cased; rules match the words joined by single blanks.  Several hundred
regular expressions are built from hand-written license names, versions and
the sentence forms they stand in; short names (``SHORT``) and sentences of the
licenses and their notices (``NOTICES``) are written out.  A rule runs only on texts that hold its
keyword.  Detections are resolved by priority: an interval that lies inside a
kept interval of a higher rule (or an earlier rule of equal priority) is
suppressed.  Base phrases are counted apart and always kept.

Defined results: null text is empty (0 words, no place, empty labels, score
0); rows that share a ``doc_id`` are each reported; an empty table gives an
empty result.  A rule's text is bounded, so a long text costs one linear pass
for each rule whose keyword it holds.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from branchbook.llm.common import batch_rows

BASE = [("gnu general public license", "gpl"), ("apache license", "apache"), ("cc by", "cc-by"),
        ("mit license", "mit")]

L = "licen[cs]e"
#: label, keyword, name (regular expression over words), versions
FAMILIES = [
    ("gpl", "gnu", f"gnu (?:general public {L}|gpl)", "1.0 2.0 3.0"),
    ("lgpl", "gnu", f"gnu (?:(?:lesser|library) general public {L}|lgpl)", "2.0 2.1 3.0"),
    ("agpl", "gnu", f"gnu (?:affero general public {L}|agpl)", "1.0 3.0"),
    ("gfdl", "gnu", f"gnu (?:free documentation {L}|fdl)", "1.1 1.2 1.3"),
    ("apache", "apache", f"apache (?:software )?{L}", "1.0 1.1 2.0"),
    ("mpl", "mozilla", f"mozilla public {L}", "1.0 1.1 2.0"),
    ("epl", "eclipse", f"eclipse public {L}", "1.0 2.0"),
    ("cddl", "common", f"common development and distribution {L}", "1.0 1.1"),
    ("cpl", "common", f"common public {L}", "1.0"),
    ("cpal", "common", f"common public attribution {L}", "1.0"),
    ("eupl", "european", f"european union public {L}", "1.0 1.1 1.2"),
    ("osl", "open", f"open software {L}", "1.0 2.0 2.1 3.0"),
    ("afl", "academic", f"academic free {L}", "1.1 1.2 2.0 2.1 3.0"),
    ("apsl", "apple", f"apple public source {L}", "1.0 1.1 1.2 2.0"),
    ("artistic", "artistic", f"artistic {L}", "1.0 2.0"),
    ("bsl", "boost", f"boost software {L}", "1.0"),
    ("busl", "business", f"business source {L}", "1.1"),
    ("cecill", "cecill", f"cecill(?: free software)? {L}", "1.0 1.1 2.0 2.1"),
    ("ms-pl", "microsoft", f"microsoft public {L}", ""),
    ("ms-rl", "microsoft", f"microsoft reciprocal {L}", ""),
    ("zpl", "zope", f"zope public {L}", "1.1 2.0 2.1"),
    ("psf", "python", f"python(?: software foundation)? {L}", "2.0"),
    ("php", "php", f"php {L}", "3.0 3.01"),
    ("ruby", "ruby", f"ruby(?: s)? {L}", ""),
    ("openssl", "openssl", f"openssl {L}", ""),
    ("w3c", "w3c", f"w3c software(?: notice and)? {L}", ""),
    ("ncsa", "ncsa", f"(?:university of illinois )?ncsa open source {L}", ""),
    ("isc", "isc", f"isc {L}", ""),
    ("zlib", "zlib", f"zlib(?: libpng)? {L}", ""),
    ("wtfpl", "fuck", f"do what the fuck you want to public {L}", ""),
    ("unlicense", "unlicense", "unlicense", ""),
    ("mit", "mit", f"mit(?: x11)? {L}", ""),
    ("mit-0", "mit", f"mit(?: 0| no attribution) {L}", ""),
    ("bsd-2-clause", "bsd", f"(?:(?:bsd )?(?:2|two) clause(?: bsd)?|simplified bsd|freebsd) {L}", ""),
    ("bsd-3-clause", "bsd", f"(?:(?:bsd )?(?:3|three) clause(?: bsd)?|(?:new|revised|modified) bsd) {L}", ""),
    ("bsd-4-clause", "bsd", f"(?:(?:bsd )?(?:4|four) clause(?: bsd)?|original bsd) {L}", ""),
    ("bsd", "bsd", f"bsd(?: style)? {L}", ""),
    ("ofl", "font", f"(?:sil )?open font {L}", "1.0 1.1"),
    ("odbl", "database", f"(?:open data commons )?open database {L}", "1.0"),
    ("odc-by", "commons", f"open data commons attribution {L}", "1.0"),
    ("pddl", "public", f"public domain dedication and {L}", "1.0"),
    ("lppl", "latex", f"latex project public {L}", "1.0 1.1 1.2 1.3"),
    ("postgresql", "postgresql", f"postgresql {L}", ""),
    ("sspl", "server", f"server side public {L}", "1.0"),
    ("elastic", "elastic", f"elastic {L}", "2.0"),
    ("upl", "universal", f"universal permissive {L}", "1.0"),
    ("vim", "vim", f"vim {L}", ""),
    ("ipl", "ibm", f"ibm public {L}", "1.0"),
    ("qpl", "q public", f"q public {L}", "1.0"),
    ("sleepycat", "sleepycat", f"sleepycat {L}", ""),
    ("xfree86", "xfree86", f"xfree86 {L}", "1.1"),
    ("ecl", "educational", f"educational community {L}", "1.0 2.0"),
    ("naumen", "naumen", f"naumen public {L}", ""),
    ("rpl", "reciprocal", f"reciprocal public {L}", "1.1 1.5"),
    ("mulan", "mulan", f"mulan (?:permissive software|psl) {L}", "1.0 2.0"),
    ("cc0", "cc0", "(?:creative commons )?cc0", "1.0"),
    ("public-domain", "public domain", "(?:dedicated to|released into|in) the public domain", ""),
]
#: Parts of the attribution licenses and their words.
CC_PARTS = {"by": "attribution", "by-sa": "attribution share ?alike", "by-nd": "attribution no ?deriv(?:ative)?s",
            "by-nc": "attribution non ?commercial", "by-nc-sa": "attribution non ?commercial share ?alike",
            "by-nc-nd": "attribution non ?commercial no ?deriv(?:ative)?s"}
CC_VERSIONS = "1.0 2.0 2.5 3.0 4.0"
GRANT = ("(?:licensed|released|distributed|available|published|covered|governed)(?: only)? (?:under|by)"
         "(?: the)?(?: terms(?: and conditions)? of)?(?: the)?")
#: form: (priority, weight, text around the name)
FORMS = {"grant": (2, 0.9, GRANT + " {}"), "name": (1, 0.7, "{}")}
VERSIONED = {
    "spdx": (4, 1.0, "spdx {} identifier {{}}".format(L)),
    "version": (3, 0.95, f"(?:{GRANT} )?" + "{} (?:version )?(?:international |unported )?(?:v ?)?{}"),
}

UNDER = ("(?:licensed|released|distributed|available|published|provided|covered|governed)(?: only)? under"
         "(?: the)?(?: terms(?: and conditions)? of)?(?: the)?")
#: label, keyword, short name, versions; what counts without a grant or the word licensed (0: nothing, as
#: the name means other things too; 1: the name with a version; 2: the name)
SHORT = [
    ("gpl", " gpl", "gpl", "1.0 2.0 3.0", 2), ("lgpl", " lgpl", "lgpl", "2.0 2.1 3.0", 2),
    ("agpl", " agpl", "agpl", "1.0 3.0", 2), ("gfdl", "fdl", "g?fdl", "1.1 1.2 1.3", 1),
    ("apache", " apache", "apache", "1.0 1.1 2.0", 0), ("mpl", " mpl", "mpl", "1.0 1.1 2.0", 1),
    ("epl", " epl", "epl", "1.0 2.0", 1), ("cddl", " cddl", "cddl", "1.0 1.1", 2),
    ("eupl", " eupl", "eupl", "1.0 1.1 1.2", 2), ("osl", " osl", "osl", "1.0 2.0 2.1 3.0", 0),
    ("afl", " afl", "afl", "1.1 1.2 2.0 2.1 3.0", 0), ("bsl", " bsl", "bsl", "1.0", 0),
    ("ofl", " ofl", "(?:sil )?ofl", "1.0 1.1", 0), ("mit", " mit", "mit(?: x11)?", "", 0),
    ("isc", " isc", "isc", "", 0), ("zlib", " zlib", "zlib", "", 0), ("wtfpl", " wtfpl", "wtfpl", "", 2),
    ("bsd-2-clause", " bsd", "(?:bsd (?:2|two) clause|(?:2|two) clause bsd|simplified bsd)", "", 2),
    ("bsd-3-clause", " bsd", "(?:bsd (?:3|three) clause|(?:3|three) clause bsd|(?:new|revised|modified) bsd)", "", 2),
    ("bsd-4-clause", " bsd", "(?:bsd (?:4|four) clause|(?:4|four) clause bsd|original bsd)", "", 2),
    ("bsd", " bsd", "bsd", "", 0),
]
_GNU_TERMS = "you can redistribute (?:it|them) and or modify (?:it|them) under the terms of the gnu {} as published by the free software foundation "
_SOFTWARE = "(?:this|the) software"
#: label, keyword, sentence
NOTICES = [
    ("mit", "hereby granted", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files"),
    ("mit", "noninfringement", "the software is provided as is without warranty of any kind express or implied including but not limited to "
     "the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("bsl-1.0", "hereby granted", "permission is hereby granted free of charge to any person or organization obtaining a copy of the software"),
    ("bsd", "binary forms", "redistributions? and use in source and binary forms with or without modification (?:is|are) permitted provided that the following conditions are met"),
    ("bsd", "implied warranties", f"{_SOFTWARE} is provided by (?:[^ ]+ ){{1,12}}as is and any express or implied warranties"),
    ("bsd-3-clause", "endorse or promote", "neither the names? of (?:[^ ]+ ){1,20}may be used to endorse or promote products derived from this software"),
    ("bsd-4-clause", "advertising materials", "all advertising materials mentioning features or use of this software must display the following acknowledge?ment"),
    ("isc", "hereby granted", f"permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted "
     "provided that the above copyright notice and this permission notice appear in all copies"),
    ("0bsd", "hereby granted", "permission to use copy modify and (?:or )?distribute this software for any purpose with or without fee is hereby granted(?! provided)"),
    ("isc", "disclaims all warranties", "the author disclaims all warranties with regard to this software"),
    ("postgresql", "hereby granted", "permission to use copy modify and distribute this software and its documentation for any purpose without fee and "
     "without a written agreement is hereby granted"),
    ("zlib", "held liable", "this software is provided as is without any express or implied warranty in no event will the authors? be held liable"),
    ("apache-2.0", "applicable law", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis"),
    ("apache-2.0", "contributor", "each contributor hereby grants to you a perpetual worldwide non exclusive no charge royalty free irrevocable copyright license"),
    ("mpl-2.0", "mozilla", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("gpl", "any warranty", "this program is distributed in the hope that it will be useful but without any warranty"),
    ("lgpl", "any warranty", "this library is distributed in the hope that it will be useful but without any warranty"),
    ("gpl-2.0", "take away your freedom", "the licenses for most software are designed to take away your freedom to share and change it"),
    ("gpl-3.0", "copyleft", "the gnu general public license is a free copyleft license for software and other kinds of works"),
    ("agpl-3.0", "copyleft", "the gnu affero general public license is a free copyleft license for software and other kinds of works"),
    ("unlicense", "unencumbered", "this is free and unencumbered software released into the public domain"),
    ("wtfpl", "fuck", "you just do what the fuck you want to"),
    ("cc0-1.0", "this deed", "the person who associated a work with this deed has dedicated the work to the public domain"),
]
for _label, _name, _versions in (("gpl", f"general public {L}", "1 2 3"), ("lgpl", f"(?:lesser|library) general public {L}", "2 2.1 3"),
                                 ("agpl", f"affero general public {L}", "3")):
    NOTICES += [(_label + "-" + (v if "." in v else v + ".0"), "redistribute",
                 _GNU_TERMS.format(_name) + f"either version {v.replace('.', ' ')}(?: of the license)?" + ("(?! 1 )" if v == "2" else ""))
                for v in _versions.split()]


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: bytes
    priority: int
    weight: float
    pattern: re.Pattern


def _words(text: str) -> str:
    """The words of an identifier, e.g. ``by-nc-4.0`` as ``by nc 4 0``."""
    return " ".join(re.findall(r"[0-9a-z]+", text))


def _version(v: str) -> str:
    """``2.0`` is written 2 or 2 0."""
    whole, _, part = v.partition(".")
    return f"{whole}(?: {part})?" if set(part) == {"0"} else f"{whole} {part}"


def _rule(label: str, keyword: str, priority: int, weight: float, body: str) -> Rule:
    return Rule(label, keyword.encode(), priority, weight, re.compile(f"(?<= ){body}(?= )".encode()))


@lru_cache(maxsize=1)
def rules() -> tuple[Rule, ...]:
    """All signatures, highest priority first."""
    out = []
    names = [(label, key, f"(?:{name})", versions.split()) for label, key, name, versions in FAMILIES]
    for part, words in CC_PARTS.items():
        out += [(f"cc-{part}", key, name, CC_VERSIONS.split()) for key, name in (
            ("cc by", f"cc {_words(part)}"), ("commons", f"creative commons {words}(?: {L})?"),
            ("creativecommons", f"creativecommons org licenses {_words(part)}"))]
    made = []
    for label, key, name, versions in names + out:
        for priority, weight, form in FORMS.values():
            made.append(_rule(label, key, priority, weight, form.format(name)))
        for v in versions:
            p, w, form = VERSIONED["version"]
            made.append(_rule(f"{label}-{v}", key, p, w, form.format(name, _version(v))))
        p, w, form = VERSIONED["spdx"]
        for full in [f"{label}-{v}" for v in versions] or [label]:
            made.append(_rule(full, "spdx", p, w, form.format(_words(full))))
    for label, key, name, versions, alone in SHORT:
        made.append(_rule(label, key, *FORMS["grant"][:2], f"{UNDER} {name}"))
        made.append(_rule(label, key, *FORMS["name"][:2], name if alone == 2 else f"{name} licen[cs]ed"))
        for v in versions.split():
            p, w, _ = VERSIONED["version"]
            full = f"{name} ?(?:{L} )?(?:v ?|version )?{_version(v)}"
            for body in (f"(?:{UNDER} )?{full}(?: {L})?",) if alone else (f"{UNDER} {full}(?: {L})?", f"{full} {L}d?"):
                made.append(_rule(f"{label}-{v}", key, p, w, body))
    made += [_rule(label, key, *VERSIONED["version"][:2], body) for label, key, body in NOTICES]
    return tuple(sorted(made, key=lambda r: -r.priority))


#: Texts without any of these have no detection.
GATE = re.compile("|".join(["licen|spdx|cc by|cc0|creative|public domain|gnu ", *sorted({key for _, key, _ in NOTICES} | {
    key for _, key, *_ in SHORT})]).encode())
_TABLE = bytes(c if 48 <= c < 58 or 97 <= c < 123 or c > 127 else c + 32 if 65 <= c < 91 else 32 for c in range(256))


def normalized(text: bytes) -> tuple[int, bytes]:
    """Number of words; the words joined (and enclosed) by single blanks."""
    words = text.translate(_TABLE).split()
    return len(words), b" " + b" ".join(words) + b" "


def base_places(norm: bytes) -> list[tuple[int, str]]:
    """(word index, label) of every place of a base phrase."""
    out = []
    for phrase, label in BASE:
        needle, at, word, counted = f" {phrase} ".encode(), -1, 0, 0
        while (at := norm.find(needle, at + 1)) >= 0:
            word += norm.count(b" ", counted, at)       # blanks since the last place: linear in the text
            counted = at
            out.append((word, label))
    return out


def detections(norm: bytes) -> list[tuple[int, int, Rule]]:
    """Kept detections: (begin, end, rule) in bytes of the normalized text."""
    has: dict[bytes, bool] = {}
    found = []
    for order, r in enumerate(rules()):
        if r.keyword not in has:
            has[r.keyword] = r.keyword in norm
        if has[r.keyword]:
            found += [(-r.priority, m.start() - m.end(), order, m.start(), m.end()) for m in r.pattern.finditer(norm)]
    found.sort()
    return [(b, e, rules()[o]) for _, _, o, b, e in _outer(found)]


def _outer(found: list[tuple]) -> list[tuple]:
    """In order of priority and length, the intervals inside no kept one.  The
    kept ones are held by begin with the farthest end so far, so a text with
    very many detections costs n log n."""
    import bisect
    begins: list[int] = []
    ends: list[int] = []                     # increasing with begins
    kept = []
    for f in found:
        b, e = f[3], f[4]
        k = bisect.bisect_right(begins, b)
        if k and ends[k - 1] >= e:
            continue
        kept.append(f)
        while k < len(begins) and ends[k] <= e:   # those inside the new one guard nothing more
            del begins[k], ends[k]
        begins.insert(k, b)
        ends.insert(k, e)
    return kept


def scan_text(text: bytes) -> tuple:
    """n_words, n_base, first_word, last_word, base_labels, labels, score."""
    n, norm = normalized(text)
    if not GATE.search(norm):
        return n, 0, None, None, "", "", 0.0
    base = base_places(norm)
    own = detections(norm)
    labels = sorted({x for _, x in base})
    both = sorted({x for _, x in base} | {r.label for _, _, r in own})
    weight = max([r.weight for _, _, r in own] + [0.5] * bool(base), default=0.0)
    places = [k for k, _ in base]
    return (n, len(base), min(places, default=None), max(places, default=None), ",".join(labels), ",".join(both), weight)


def _scan_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    types = (pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.string(), pa.float64())
    names = ["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score"]
    for b in batches:
        out = [(i, *scan_text(t or b"")) for i, t in batch_rows(b, "doc_id", "text")]
        if out:
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*out), types)], names)


def scan(docs: DataFrame) -> DataFrame:
    """One row per document: base phrases, all labels and the best weight."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text")).mapInArrow(
        _scan_batches, "doc_id long, n_words long, n_base long, first_word long, last_word long, "
                       "base_labels string, labels string, score double")
