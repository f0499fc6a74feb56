"""Licence scans by ordered signature rules.

Signatures are regular expressions over the lower-cased text, several hundred in
all: a table of licence names, each in every phrasing a notice uses, besides a
few passages of licence texts. One pass of a keyword automaton tells which single
words stand in the text, however they are spaced, and so which rules can match;
only those run. A hit inside a hit of higher priority, or of the same
priority and longer, is dropped.
"""

from __future__ import annotations

import re
from bisect import bisect_left, bisect_right
from collections.abc import Iterable
from dataclasses import dataclass
from functools import lru_cache

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tagweave.llm.common import documents, map_batches, slim

_WORD = re.compile(rb"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
_BASE = (
    ("mit", (b"mit", b"license")),
    ("apache", (b"apache", b"license")),
    ("gpl", (b"general", b"public", b"license")),
)
_BASE_GATE = b"license"

# Identifier, words that any notice of the licence holds (all of them, of one
# alternative), and its name.
_NAMES = (
    ("mit", "mit|expat|x11", r"(?:the )?(?:mit|expat|x11)"),
    ("mit-0", "attribution", r"mit no attribution"),
    ("apache-1.1", "apache", r"apache(?: software)? license,? ?(?:version |v)?1\.1"),
    ("apache-2.0", "apache", r"apache(?: software)? license,? ?(?:version |v)?2(?:\.0)?"),
    ("apache", "apache", r"apache(?: software)?"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd[ -]2[ -]clause|two[ -]clause bsd)"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|bsd[ -]3[ -]clause|three[ -]clause bsd)"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd[ -]4[ -]clause|four[ -]clause bsd)"),
    ("0bsd", "bsd", r"(?:zero[ -]clause bsd|0bsd)"),
    ("bsd", "bsd|berkeley", r"(?:berkeley|bsd)"),
    ("gpl-1.0", "general public|gpl", r"(?:gnu )?(?:general public license|gpl),? ?(?:version |v)?1(?:\.0)?"),
    ("gpl-2.0", "general public", r"(?:gnu )?general public license,? ?(?:version |v)?2(?:\.0)?"),
    ("gpl-3.0", "general public", r"(?:gnu )?general public license,? ?(?:version |v)?3(?:\.0)?"),
    ("gpl", "general public", r"(?:gnu )?general public"),
    ("gpl-2.0-short", "gpl", r"(?:gnu )?gplv?[ -]?2(?:\.0)?"),
    ("gpl-3.0-short", "gpl", r"(?:gnu )?gplv?[ -]?3(?:\.0)?"),
    ("lgpl-2.0", "library", r"(?:gnu )?library general public license,? ?(?:version |v)?2(?:\.0)?"),
    ("lgpl-2.1", "lesser", r"(?:gnu )?lesser general public license,? ?(?:version |v)?2\.1"),
    ("lgpl-3.0", "lesser", r"(?:gnu )?lesser general public license,? ?(?:version |v)?3(?:\.0)?"),
    ("lgpl", "lesser", r"(?:gnu )?lesser general public"),
    ("agpl-3.0", "affero", r"(?:gnu )?affero general public license,? ?(?:version |v)?3(?:\.0)?"),
    ("agpl", "affero", r"(?:gnu )?affero general public"),
    ("gfdl", "documentation", r"(?:gnu )?free documentation"),
    ("mpl-1.1", "mozilla", r"mozilla public license,? ?(?:version |v)?1\.1"),
    ("mpl-2.0", "mozilla", r"mozilla public license,? ?(?:version |v)?2(?:\.0)?"),
    ("mpl", "mozilla", r"mozilla public"),
    ("epl-1.0", "eclipse", r"eclipse public license,? ?(?:-? ?v|version )?1(?:\.0)?"),
    ("epl-2.0", "eclipse", r"eclipse public license,? ?(?:-? ?v|version )?2(?:\.0)?"),
    ("epl", "eclipse", r"eclipse public"),
    ("edl-1.0", "eclipse", r"eclipse distribution"),
    ("cddl-1.0", "common development", r"common development and distribution"),
    ("cpl-1.0", "common public", r"common public"),
    ("cpal-1.0", "attribution", r"common public attribution"),
    ("eupl-1.2", "european union", r"european union public"),
    ("isc", "isc", r"(?:the )?isc"),
    ("zlib", "zlib", r"(?:the )?zlib(?:/libpng)?"),
    ("bsl-1.0", "boost", r"boost software"),
    ("unlicense", "unlicense", r"(?:the )?unlicense"),
    ("wtfpl", "wtfpl", r"(?:the )?wtfpl"),
    ("artistic-1.0", "artistic", r"artistic license,? ?(?:version |v)?1(?:\.0)?"),
    ("artistic-2.0", "artistic", r"artistic license,? ?(?:version |v)?2(?:\.0)?"),
    ("artistic", "artistic", r"artistic"),
    ("python-2.0", "python", r"python(?: software foundation)?"),
    ("php-3.0", "php", r"php"),
    ("postgresql", "postgresql", r"postgresql"),
    ("openssl", "openssl", r"openssl"),
    ("ofl-1.1", "open font", r"sil open font"),
    ("ms-pl", "microsoft", r"microsoft public"),
    ("ms-rl", "microsoft", r"microsoft reciprocal"),
    ("ncsa", "ncsa", r"(?:university of illinois/)?ncsa(?: open source)?"),
    ("odbl-1.0", "open database", r"open database"),
    ("odc-by-1.0", "open data commons", r"open data commons attribution"),
    ("pddl-1.0", "open data commons", r"open data commons public domain dedication"),
    ("cc0-1.0", "cc0", r"(?:creative commons )?cc0(?: 1\.0)?"),
    ("cc-by-3.0", "creative commons", r"creative commons attribution 3\.0"),
    ("cc-by-4.0", "creative commons", r"creative commons attribution 4\.0"),
    ("cc-by-sa-3.0", "creative commons", r"creative commons attribution-share ?alike 3\.0"),
    ("cc-by-sa-4.0", "creative commons", r"creative commons attribution-share ?alike 4\.0"),
    ("cc-by-nc-4.0", "creative commons", r"creative commons attribution-non ?commercial 4\.0"),
    ("cc-by-nd-4.0", "creative commons", r"creative commons attribution-no ?deriv(?:ative)?s 4\.0"),
    ("cc-by-nc-sa-4.0", "creative commons", r"creative commons attribution-non ?commercial-share ?alike 4\.0"),
    ("cc", "creative commons", r"creative commons"),
    ("ecl-2.0", "educational", r"educational community"),
    ("upl-1.0", "universal", r"universal permissive"),
    ("bsl-1.1", "business source", r"business source"),
    ("sspl-1.0", "server side", r"server side public"),
    ("elastic-2.0", "elastic", r"elastic"),
    ("vim", "vim", r"vim"),
    ("ruby", "ruby", r"ruby"),
    ("tex", "latex", r"latex project public"),
    ("afl-3.0", "academic", r"academic free"),
    ("osl-3.0", "open software", r"open software"),
    ("json", "json", r"json"),
    ("beerware", "beer ware", r"beer ?ware"),
)
# Phrasings, by falling priority: what stands around a name, and a score.
_PHRASINGS = (
    (4, 1.0, r"spdx-license-identifier:? *\(?{ident}(?:-only|-or-later|\+)?(?![a-z0-9.+-])", True),
    (4, 1.0, r"spdx-license-identifier:? *(?:\(?[a-z0-9.+-]{1,40}\)?\s+(?:or|and|with)\s+){1,5}\(?({ident}(?:-only|-or-later|\+)?)(?![a-z0-9.+-])", True),
    (3, 0.95, r"(?:licensed|released|distributed|published|available|provided) under (?:the )?(?:terms (?:and conditions )?of (?:the )?)?{name}(?![a-z0-9])(?: licen[cs]e)?", False),
    (3, 0.9, r"licen[cs]e: *{name}\b", False),
    (2, 0.7, r"{name} licen[cs]e", False),
    (2, 0.6, r"licen[cs]ed {name}\b", False),
)
# Passages that only one licence's text has.
_PASSAGES = (
    ("mit", "hereby granted", r"permission is hereby granted, free of charge, to any person obtaining a copy"),
    ("isc", "permission distribute purpose", r"permission to use, copy, modify, and(?:/or)? distribute this software for any purpose"),
    ("bsd", "redistribution", r"redistributions? (?:and use )?(?:in|of) source (?:and binary forms|code)"),
    ("zlib", "warranty", r"this software is provided 'as-is', without any express or implied warranty"),
    ("unlicense", "public domain", r"this is free and unencumbered software released into the public domain"),
    ("cc0-1.0", "waived", r"waived all copyright and related or neighboring rights"),
    ("public-domain", "public domain", r"(?:released|dedicated|placed) (?:in|into|to) the public domain"),
    ("proprietary", "all rights reserved", r"all rights reserved"),
)
# Signatures of single licences that stand by themselves: how each is quoted,
# headed, abbreviated or linked.
_SIGNATURES = (
    ("gpl-2.0", "gpl", r"gpl,? ?(?:version|ver\.?|v\.?) ?2(?:\.0)?(?![.0-9])"),
    ("gpl-2.0", "gplv2", r"gplv2(?:\+|\.0)?(?![.0-9])"),
    ("gpl-2.0", "either version license", r"general public license[^.]{0,200}? either version 2 of the license"),
    ("gpl-2.0", "gnu licenses", r"gnu\.org/licenses/(?:old-licenses/)?gpl-2\.0"),
    ("gpl-3.0", "gpl", r"gpl,? ?(?:version|ver\.?|v\.?) ?3(?:\.0)?(?![.0-9])"),
    ("gpl-3.0", "gplv3", r"gplv3(?:\+|\.0)?(?![.0-9])"),
    ("gpl-3.0", "either version license", r"general public license[^.]{0,200}? either version 3 of the license"),
    ("gpl-3.0", "gnu licenses", r"gnu\.org/licenses/gpl(?:-3\.0)?(?:\.html|\.txt)?(?![-a-z0-9])"),
    ("lgpl-2.1", "lgpl", r"lgpl,? ?(?:version |v\.? ?|-)?2\.1(?![.0-9])"),
    ("lgpl-2.1", "gnu licenses", r"gnu\.org/licenses/(?:old-licenses/)?lgpl-2\.1"),
    ("lgpl-3.0", "lgpl", r"lgpl,? ?(?:version |v\.? ?|-)?3(?:\.0)?(?![.0-9])"),
    ("lgpl-3.0", "gnu licenses", r"gnu\.org/licenses/lgpl-3\.0"),
    ("agpl-3.0", "agpl", r"agpl,? ?(?:version |v\.? ?|-)?3(?:\.0)?(?![.0-9])"),
    ("agpl-3.0", "gnu licenses", r"gnu\.org/licenses/agpl-3\.0"),
    ("apache-2.0", "apache licenses", r"apache\.org/licenses/license-2\.0"),
    ("apache-2.0", "apache license version", r"apache license\s*,? version 2\.0, january 2004"),
    ("mit", "opensource", r"opensource\.org/licen[cs]es?/mit(?![-a-z0-9])"),
    ("mit", "choosealicense", r"choosealicense\.com/licenses/mit(?![-a-z0-9])"),
    ("mit", "permission notice substantial", r"the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    ("bsd-2-clause", "bsd clause", r"bsd(?:-|\s+)2(?:-|\s+)clause(?: \"simplified\")? licen[cs]e"),
    ("bsd-3-clause", "bsd clause", r"bsd(?:-|\s+)3(?:-|\s+)clause(?: \"(?:new|revised)\"(?: or \"(?:new|revised)\")?)? licen[cs]e"),
    ("bsd-3-clause", "opensource", r"opensource\.org/licen[cs]es?/bsd-3-clause"),
    ("bsd-3-clause", "endorse", r"neither the name of [^.]{1,120}? nor the names of (?:its|their) contributors may be used to endorse"),
    ("cc-by-4.0", "cc by 4.0", r"cc(?:-|\s+)by(?:-|\s+)4\.0(?![.0-9])"),
    ("cc-by-4.0", "creativecommons", r"creativecommons\.org/licenses/by/4\.0"),
    ("cc-by-sa-4.0", "cc by 4.0", r"cc(?:-|\s+)by(?:-|\s+)sa(?:-|\s+)4\.0(?![.0-9])"),
    ("cc-by-sa-4.0", "creativecommons", r"creativecommons\.org/licenses/by-sa/4\.0"),
    ("cc-by-sa-4.0", "creative commons", r"creative commons attribution(?:-|\s+)share ?alike 4\.0 international"),
    ("cc-by-nc-4.0", "cc by 4.0", r"cc(?:-|\s+)by(?:-|\s+)nc(?:-|\s+)4\.0(?![.0-9])"),
    ("cc-by-nc-4.0", "creativecommons", r"creativecommons\.org/licenses/by-nc/4\.0"),
    ("cc-by-nc-sa-4.0", "cc by 4.0", r"cc(?:-|\s+)by(?:-|\s+)nc(?:-|\s+)sa(?:-|\s+)4\.0(?![.0-9])"),
    ("cc-by-nd-4.0", "cc by 4.0", r"cc(?:-|\s+)by(?:-|\s+)nd(?:-|\s+)4\.0(?![.0-9])"),
    ("cc-by-3.0", "cc by 3.0", r"cc(?:-|\s+)by(?:-|\s+)3\.0(?![.0-9])"),
    ("cc-by-3.0", "creativecommons", r"creativecommons\.org/licenses/by/3\.0"),
    ("cc-by-sa-3.0", "cc by 3.0", r"cc(?:-|\s+)by(?:-|\s+)sa(?:-|\s+)3\.0(?![.0-9])"),
    ("cc0-1.0", "creativecommons", r"creativecommons\.org/publicdomain/zero/1\.0"),
    ("mpl-2.0", "mozilla", r"mozilla\.org/(?:en-us/)?mpl/2\.0"),
    ("mpl-2.0", "mpl 2.0", r"mpl(?:-|\s+)?(?:v|version )?2\.0(?![.0-9])"),
    ("epl-2.0", "eclipse legal", r"eclipse\.org/legal/epl-(?:v)?2"),
    ("unlicense", "unlicense", r"unlicense\.org"),
    ("wtfpl", "do what the you want to", r"do what the f[a-z*]{2,3} you want to public license"),
    ("bsl-1.0", "boost license_1_0", r"boost\.org/license_1_0\.txt"),
    ("isc", "opensource", r"opensource\.org/licen[cs]es?/isc(?![-a-z0-9])"),
    ("zlib", "altered", r"altered source versions must be plainly marked as such"),
    ("ofl-1.1", "scripts.sil.org", r"scripts\.sil\.org/ofl"),
)


@dataclass(frozen=True)
class Rule:
    label: str
    keyword: str
    pattern: re.Pattern
    priority: int
    score: float


@dataclass(frozen=True)
class Hit:
    label: str
    start: int
    end: int
    priority: int
    score: float


def _loose(pattern: str) -> str:
    """Any white space where the pattern has a blank; an optional blank stays optional."""
    return re.sub(r" (?![-*?])", r"\\s+", re.sub(r" [*?]", r"\\s*", pattern))


def build_rules() -> tuple[Rule, ...]:
    """All signatures in order: passages, single signatures, then every name in every phrasing, by priority."""
    rules = [Rule(label, word, re.compile(_loose(text)), 5, 1.0) for label, word, text in _PASSAGES]
    rules += [Rule(label, word, re.compile(r"(?<![a-z0-9])" + _loose(text)), 3, 0.9) for label, word, text in _SIGNATURES]
    for ident, word, name in _NAMES:
        label = ident.removesuffix("-short")
        for priority, score, phrase, by_ident in _PHRASINGS:
            text = phrase.replace("{ident}", re.escape(label)).replace("{name}", f"(?:{name})")
            keyword = "spdx-license" if by_ident else word
            pattern = re.compile(r"(?<![a-z0-9])" + _loose(text))
            rules.append(Rule(label, keyword, pattern, priority, score))
    return tuple(sorted(rules, key=lambda r: -r.priority))


@lru_cache(maxsize=1)
def _machine():
    """The rules, the sets of words of which one must be there for some rules, and an automaton over the words."""
    import ahocorasick

    rules, by_keyword = build_rules(), {}
    for i, rule in enumerate(rules):
        by_keyword.setdefault(rule.keyword, []).append(i)
    gates = [([frozenset(words.split()) for words in keyword.split("|")], numbers) for keyword, numbers in by_keyword.items()]
    automaton = ahocorasick.Automaton()
    for word in {word for sets, _ in gates for words in sets for word in words}:
        automaton.add_word(word, word)
    automaton.make_automaton()
    return rules, gates, automaton


def hits_of(rule: Rule, lowered: str) -> list[Hit]:
    """A rule's matches; of an operand behind others in an expression, the operand alone."""
    part = rule.pattern.groups
    return [Hit(rule.label, *m.span(part), rule.priority, rule.score) for m in rule.pattern.finditer(lowered)]


def suppress(hits: Iterable[Hit]) -> list[Hit]:
    """Drop every hit inside a kept one that comes earlier by priority, length, place and label.

    The outermost intervals kept so far stand in a row in which starts and ends
    both rise, so one search tells whether any of them holds a hit.
    """
    kept: list[Hit] = []
    starts: list[int] = []
    ends: list[int] = []
    for h in sorted(hits, key=lambda h: (-h.priority, h.start - h.end, h.start, h.label)):
        at = bisect_right(starts, h.start)
        if at and ends[at - 1] >= h.end:
            continue
        kept.append(h)
        first = bisect_left(starts, h.start)
        last = bisect_right(ends, h.end)  # those between lie inside this one
        starts[first:last], ends[first:last] = [h.start], [h.end]
    return sorted(kept, key=lambda h: (h.start, h.end))


def scan(lowered: str) -> list[Hit]:
    """The hits that remain in a text whose A-Z are lower-cased."""
    rules, gates, automaton = _machine()
    there = {word for _, word in automaton.iter(lowered)}
    wanted = sorted(i for sets, numbers in gates if any(words <= there for words in sets) for i in numbers)
    hits: list[Hit] = []
    for rule in (rules[i] for i in wanted):
        hits += hits_of(rule, lowered)
    return suppress(hits)


def base_places(words: list[bytes]) -> list[tuple[int, str]]:
    """Word numbers at which a base phrase starts, with its label."""
    found = []
    for label, phrase in _BASE:
        n = len(phrase)
        at = -1
        while True:
            try:
                at = words.index(phrase[-1], at + 1)
            except ValueError:
                break
            if at >= n - 1 and tuple(words[at - n + 1 : at + 1]) == phrase:
                found.append((at - n + 1, label))
    return sorted(found)


SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double, hits string"
)


def _scan_rows(batch: pa.RecordBatch) -> dict:
    out: dict[str, list] = {field.split()[0]: [] for field in SCHEMA.split(",")}
    for text in batch.column("text").to_pylist():
        data = text.encode("utf-8", "surrogatepass").lower()  # bytes: A-Z only
        words = _WORD.findall(data)
        places = base_places(words) if _BASE_GATE in data else []
        hits = scan(data.decode("utf-8", "surrogatepass"))
        base = sorted({label for _, label in places})
        out["n_words"].append(len(words))
        out["n_base"].append(len(places))
        out["first_word"].append(places[0][0] if places else None)
        out["last_word"].append(places[-1][0] if places else None)
        out["base_labels"].append(",".join(base))
        out["labels"].append(",".join(sorted({*base, *(h.label for h in hits)})))
        out["score"].append(max([h.score for h in hits] + [0.5] * bool(places), default=0.0))
        out["hits"].append(",".join(f"{h.label}:{h.start}:{h.end}" for h in hits))
    return out | {"doc_id": batch.column("doc_id")}


def scan_licences(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: base phrases by word, all labels, a score, and the hits' spans in code points.

    A null text counts as empty: no words, no labels, score 0. Repeated rows and
    null ids give rows of their own.
    """
    return map_batches(slim(docs, id_col, text_col), _scan_rows, SCHEMA)


def op7_licence_rules(spark: SparkSession, folder: str) -> DataFrame:
    return scan_licences(documents(spark, folder))


