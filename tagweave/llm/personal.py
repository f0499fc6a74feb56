"""Personal data, also where it is disguised, at its place in the original text.

Transducers rewrite a text step by step (look-alike letters, bracketed or spelled
``at`` and ``dot``, spelled digits, letters among digits) and keep for every
character they put out the stretch of the source it stands for. The same
detectors then run on the original and on the rewritten text, and what is found
in the latter is mapped back to the source.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tagweave.llm.common import digest_spans, documents, map_batches, slim

KINDS = ("email", "ip", "card", "phone")
Span = tuple[int, int, int]  # kind, start, end

_LOCAL_END = re.compile(r"[A-Za-z0-9._%+-]+\Z")
_DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
_IP = re.compile(r"(?<![0-9])[0-9]+\.[0-9]+\.[0-9]+\.[0-9]+")
_CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])+")
_PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
_DIGIT = re.compile(r"[0-9]")
_LOCAL = frozenset("ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-")


def emails(text: str) -> Iterable[tuple[int, int]]:
    """Leftmost matches of the address pattern, found from each ``@`` so that long words cost nothing."""
    at, free = text.find("@"), 0
    while at >= 0:
        start = at
        while start > free and text[start - 1] in _LOCAL:
            start -= 1
        if start < at and (domain := _DOMAIN.match(text, at + 1)):
            free = domain.end()
            yield start, free
        at = text.find("@", max(at + 1, free))


def luhn(digits: str) -> bool:
    total = 0
    for i, c in enumerate(reversed(digits)):
        d = int(c) * (1 + i % 2)
        total += d - 9 * (d > 9)
    return total % 10 == 0


def _digits(text: str) -> str:
    return "".join(_DIGIT.findall(text))


def detect(text: str) -> list[Span]:
    """All spans of the four kinds, by kind, then start. A match that fails its test is dropped."""
    found = [(0, *span) for span in emails(text)] if "@" in text else []
    if not _DIGIT.search(text):
        return found
    for m in _IP.finditer(text):
        if all(len(part.lstrip("0")) <= 3 and int(part.lstrip("0") or 0) <= 255 for part in m[0].split(".")):
            found.append((1, *m.span()))
    for m in _CARD.finditer(text):
        if m.end() - m.start() >= 16 and 16 <= len(digits := _digits(m[0])) <= 19 and luhn(digits):
            found.append((2, *m.span()))
    if "+" in text:
        found += [(3, *m.span()) for m in _PHONE.finditer(text) if 8 <= len(_digits(m[0])) <= 15]
    return found


class Tape:
    """A rewritten text and, for each of its characters, where the source stretch begins and ends."""

    def __init__(self, text: str) -> None:
        self.text = text
        self.starts: list[int] = list(range(len(text)))
        self.ends: list[int] = list(range(1, len(text) + 1))

    def rewrite(self, pattern: re.Pattern, change: Callable[[re.Match], str]) -> None:
        """Put ``change(match)`` for each match; every new character stands for the whole match.

        A change of equal length keeps its characters' own places.
        """
        texts, starts, ends, last = [], [], [], 0
        for m in pattern.finditer(self.text):
            a, b = m.span()
            new = change(m)
            if new == m[0] or a == b:
                continue
            texts += [self.text[last:a], new]
            starts += self.starts[last:a]
            ends += self.ends[last:a]
            if len(new) == b - a:
                starts += self.starts[a:b]
                ends += self.ends[a:b]
            else:
                starts += [self.starts[a]] * len(new)
                ends += [self.ends[b - 1]] * len(new)
            last = b
        if texts:
            self.text = "".join([*texts, self.text[last:]])
            self.starts = starts + self.starts[last:]
            self.ends = ends + self.ends[last:]


# Letters of other scripts that look like Latin ones, in pairs.
_PAIRS = (
    "аaеeоoрpсcуyхxіiјjѕsԁdһhкkАAВBЕEКKМMНHОOРPСCТTХXІIЈJЅS"
    "οoαaνvρpιiκkυuΑAΒBΕEΖZΗHΙIΚKΜMΝNΟOΡPΤTΥYΧX"
    "․.。.．.‐-‑-‒-–-—-−-"
)
_LOOKALIKE = dict(zip(_PAIRS[::2], _PAIRS[1::2], strict=True)) | {chr(0xFEE0 + c): chr(c) for c in range(0x21, 0x7F)}
_ODD = re.compile(f"[{re.escape(''.join(_LOOKALIKE))}]")
_UNSEEN = re.compile("[­​-‍⁠﻿]+")

_OPEN, _CLOSE = r"[\[({<]\x20*", r"\x20*[\])}>]"
_IN_BRACKETS = re.compile(rf"(?i)\x20*{_OPEN}(at|dot|@|\.){_CLOSE}\x20*")
# Endings that make a spelled-out domain credible.
_ENDINGS = "com|org|net|edu|gov|int|info|io|co|biz|dev|app|eu|uk|de|fr|es|it|nl|ch|at|us|example|test"
# Dotted words that no address follows are passed over whole, or each would be tried again.
_SPELLED = re.compile(
    rf"(?i)(?<![A-Za-z0-9._%+-])(?:([A-Za-z0-9._%+-]++(?:\x20+dot\x20+[A-Za-z0-9._%+-]++)*+)(\x20+at\x20+|@)([A-Za-z0-9-]+"
    rf"(?:\x20+dot\x20+[A-Za-z0-9-]+)*(?:\x20+dot\x20+|\.)(?:{_ENDINGS}))(?![A-Za-z0-9-])"
    rf"|[A-Za-z0-9._%+-]++(?:\x20+dot\x20+[A-Za-z0-9._%+-]++)++)"
)
_DOT_WORD = re.compile(r"(?i)\x20+dot\x20+")
_SPELLED_IP = re.compile(r"(?i)(?<![A-Za-z0-9])[0-9]+(?:(?:\x20+dot\x20+|\.)[0-9]+){3}(?![A-Za-z0-9])")
# The digits' names.
_NAMES = dict(zip("zero one two three four five six seven eight nine oh".split(), "01234567890", strict=True))
_NAME = "|".join(_NAMES)
_SPELLED_RUN = re.compile(rf"(?i)(?<![A-Za-z0-9])(?:plus[\x20-]+)?(?:{_NAME}|[0-9]+)(?:[\x20,-]+(?:{_NAME}|[0-9]+))+(?![A-Za-z0-9])")
_NAME_WORD = re.compile(rf"(?i){_NAME}")
_FEWEST_SPELLED = 7
_MIXED = re.compile(r"(?<![A-Za-z0-9])(?=[0-9 -]*[OoIl])[0-9OoIl]{4}(?:[\x20-]?[0-9OoIl]{4}){3}(?![A-Za-z0-9])")
_TO_DIGITS = str.maketrans("OoIl", "0011")


def _say_mail(m: re.Match) -> str:
    """The address in signs, if ``at`` and a ``dot`` are words; plain prose keeps its words."""
    if m[2] is None or m[2] != "@" and not _DOT_WORD.search(m[0]):
        return m[0]
    return f"{_DOT_WORD.sub('.', m[1])}@{_DOT_WORD.sub('.', m[3])}"


def _say_digits(m: re.Match) -> str:
    names = _NAME_WORD.findall(m[0])
    if len(names) < _FEWEST_SPELLED:
        return m[0]
    said = _NAME_WORD.sub(lambda x: _NAMES[x[0].lower()], m[0])
    return re.sub(r"[\x20,-]+", " ", re.sub(r"(?i)plus[\x20-]+", "+", said))


def normalise(text: str) -> Tape:
    tape = Tape(text)
    if not text.isascii():
        tape.rewrite(_UNSEEN, lambda m: "")
        tape.rewrite(_ODD, lambda m: _LOOKALIKE[m[0]])
    tape.rewrite(_IN_BRACKETS, lambda m: {"at": "@", "dot": "."}.get(m[1].lower(), m[1]))
    tape.rewrite(_SPELLED, _say_mail)
    tape.rewrite(_SPELLED_IP, lambda m: _DOT_WORD.sub(".", m[0]))
    tape.rewrite(_SPELLED_RUN, _say_digits)
    tape.rewrite(_MIXED, lambda m: m[0].translate(_TO_DIGITS))
    return tape


_MAY_HIDE = re.compile(
    rf"(?i){_IN_BRACKETS.pattern.removeprefix('(?i)')}|\x20dot\x20|(?:{_NAME})[\x20,-]+(?:{_NAME})[\x20,-]+(?:{_NAME})"
)


def hidden(text: str, base: list[Span]) -> list[Span]:
    """Spans that only the rewritten text shows; none that lies within a base span of its kind."""
    odd = not text.isascii() and (_ODD.search(text) or _UNSEEN.search(text))
    if not (odd or _MAY_HIDE.search(text) or (_DIGIT.search(text) and _MIXED.search(text))):
        return []
    tape = normalise(text)
    if tape.text == text:
        return []
    found = []
    for kind, start, end in detect(tape.text):
        a, b = tape.starts[start], tape.ends[end - 1]
        if not any(k == kind and s <= a and b <= e for k, s, e in base):
            found.append((kind, a, b))
    return found


def say(spans: Iterable[Span]) -> list[str]:
    return [f"{KINDS[kind]}:{start}:{end}" for kind, start, end in sorted(spans)]


def mask(text: str, spans: Iterable[Span]) -> str:
    """The text with every span replaced by its kind; of overlapping spans the first counts."""
    out, last = [], 0
    for kind, start, end in sorted(spans, key=lambda s: (s[1], -s[2])):
        if start >= last:
            out += [text[last:start], f"<{KINDS[kind]}>"]
            last = end
    return "".join([*out, text[last:]])


SCHEMA = (
    "doc_id long, n_email long, n_ip long, n_card long, n_phone long, base_sha256 string, spans string, n_hidden long,"
    " masked string"
)


def _find_rows(batch: pa.RecordBatch, with_masked: bool) -> dict:
    out: dict[str, list] = {field.split()[0]: [] for field in SCHEMA.split(",")}
    for text in batch.column("text").to_pylist():
        base = detect(text)
        more = hidden(text, base)
        for kind, name in enumerate(KINDS):
            out[f"n_{name}"].append(sum(k == kind for k, _, _ in base))
        out["base_sha256"].append(digest_spans(say(base)))
        out["spans"].append(",".join(say(base + more)))
        out["n_hidden"].append(len(more))
        out["masked"].append((mask(text, base + more) if base or more else text) if with_masked else None)
    return out | {"doc_id": batch.column("doc_id")}


def find_personal_data(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", with_masked: bool = False
) -> DataFrame:
    """One row per input row: counts of undisguised findings, all spans in code points, and the masked text.

    A null text counts as empty. Repeated rows and null ids give rows of their own.
    """
    return map_batches(slim(docs, id_col, text_col), _find_rows, SCHEMA, with_masked=with_masked)


def op3_deobfuscated_pii(spark: SparkSession, folder: str) -> DataFrame:
    return find_personal_data(documents(spark, folder)).drop("masked")
