"""Byte-exact alignment of two tokenizers' tokens.

A text's tokens by a byte-level BPE (A) and by a sentence-piece model (B) cover
the same bytes. Where tokens of both end, a group ends; an A and a B token are
linked when their bytes overlap, which makes one link for every place where any
token ends. Neither tokenizer forms a token over a single blank or line end that
stands between other characters, so usual texts are cut there, and each chunk is
aligned once, with all new chunks of a run in one call. Any other text is aligned
whole. Both ways give the same.
"""

from __future__ import annotations

import os
import re
from collections.abc import Sequence
from typing import NamedTuple

import numpy as np

from tagweave.llm.tokens import tokenizer_path

TOKENIZER_A = "byte_bpe_50k.json"
TOKENIZER_B = "piece_bpe_32k.model"
# Chunks of a generation of the cache; two generations are kept.
CACHED_CHUNKS = 100_000
# Characters of new chunks that are encoded in one call.
CALL_CHARS = 200_000

# Characters whose class no Unicode version changed, and white space that is not single.
_UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")
_WHITE_RUNS = ("  ", "\n\n", " \n", "\n ", "\t", "\r")
_CUT = re.compile(r"(?<=[^\t\n\r ])(?=[ \n][^\t\n\r ])")
# A chunk that may stand next to others: what the cuts give, but for white space at a text's ends.
_REGULAR = re.compile(r"[ \n][^\t\n\r ](?:.*[^\t\n\r ])?", re.DOTALL)
_PLAIN = " x"


class Aligned(NamedTuple):
    """Counts, the groups as text, and the linked ids as ``B << 32 | A``, one item a link."""

    n_a: int
    n_b: int
    n_groups: int
    groups: str
    links: bytes


class Differs(NamedTuple):
    """Stands for a chunk whose tokens do not spell it."""


def _byte_of_character() -> dict[str, int]:
    """Which byte a character of a byte-level vocabulary stands for."""
    shown = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    hidden = [b for b in range(256) if b not in set(shown)]
    return {chr(b): b for b in shown} | {chr(256 + i): b for i, b in enumerate(hidden)}


class Aligner:
    def __init__(self, name_a: str, name_b: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from sentencepiece import SentencePieceProcessor
        from tokenizers import Tokenizer

        self._a = Tokenizer.from_file(tokenizer_path(name_a))
        self._a.encode_special_tokens = True
        self._b = SentencePieceProcessor(model_file=tokenizer_path(name_b))
        byte = _byte_of_character()
        entries = self._a.get_vocab(with_added_tokens=True)
        self._bytes_a = [b""] * (max(entries.values()) + 1)
        for entry, i in entries.items():
            self._bytes_a[i] = bytes(byte[c] for c in entry) if all(c in byte for c in entry) else entry.encode()
        pieces = [self._b.id_to_piece(i) for i in range(self._b.get_piece_size())]
        self._bytes_b = [
            bytes([int(p[3:5], 16)]) if self._b.is_byte(i) else p.replace("▁", " ").encode() for i, p in enumerate(pieces)
        ]
        self._cuts = not any(re.search("[^▁]▁|\n", p) for p in pieces)
        self._length_a = np.array([len(x) for x in self._bytes_a])
        self._length_b = np.array([len(x) for x in self._bytes_b])
        self._names = [str(i) for i in range(max(len(self._bytes_a), len(self._bytes_b)))]
        self._recent: dict[str, Aligned | Differs] = {}
        self._older: dict[str, Aligned | Differs] = {}

    def chunks(self, text: str) -> list[str] | None:
        """The chunks of a blank and the text, or None where it must be aligned whole."""
        if not self._cuts or _UNUSUAL.search(text):
            return None
        whole = " " + text
        if any(x in whole for x in _WHITE_RUNS) or whole[-1] in " \n":
            return _CUT.split(whole)
        return whole.replace(" ", "\0 ").replace("\n", "\0\n").split("\0")[1:]

    def whole(self, text: str) -> Aligned | Differs:
        return self._align([" " + text])[0]

    def look_up(self, chunks: Sequence[str]) -> list[Aligned | Differs]:
        """The alignments of distinct chunks; those not met lately are made together."""
        if len(self._recent) > CACHED_CHUNKS:
            self._older, self._recent = self._recent, {}
        recent, older = self._recent, self._older
        new: list[str] = []
        for chunk in chunks:
            if chunk not in recent:
                if chunk in older:
                    recent[chunk] = older[chunk]
                else:
                    new.append(chunk)
        self._learn(new)
        return [recent[c] for c in chunks]

    def _learn(self, new: list[str]) -> None:
        together, size = [_PLAIN], 0
        for chunk in new:
            if _REGULAR.fullmatch(chunk):
                together.append(chunk)
                size += len(chunk)
                if size >= CALL_CHARS:
                    self._recent.update(zip(together, self._align(together), strict=True))
                    together, size = [_PLAIN], 0
            else:
                self._recent[chunk] = self._align([chunk] if chunk[0] == " " else [_PLAIN, chunk])[-1]
        if len(together) > 1:
            self._recent.update(zip(together, self._align(together), strict=True))

    def _align(self, parts: list[str]) -> list[Aligned | Differs]:
        """Align parts that stand one after the other; the first begins with a blank."""
        text = "".join(parts)
        data = text.encode()
        a = np.array(self._a.encode_batch_fast([text], add_special_tokens=False)[0].ids, np.int64)
        b = np.array(self._b.encode(text[1:]), np.int64)
        spelled = (b"".join(map(t.__getitem__, ids.tolist())) for t, ids in ((self._bytes_a, a), (self._bytes_b, b)))
        if not len(a) or not len(b) or not all(x == data for x in spelled):
            if len(parts) == 1:
                return [Differs()]
            if len(parts) == 2 and parts[0] == _PLAIN:
                return [*self._align(parts[:1]), Differs()]
            return [*self._align(parts[:1]), *[self._align([_PLAIN, p])[1] for p in parts[1:]]]
        end_a, end_b = np.cumsum(self._length_a[a]), np.cumsum(self._length_b[b])
        ends = np.union1d(end_a, end_b)
        links = (b[np.searchsorted(end_b, ends)] << 32) | a[np.searchsorted(end_a, ends)]
        groups = np.intersect1d(end_a, end_b, assume_unique=True)
        shown = self._show(a, b, np.searchsorted(end_a, groups) + 1, np.searchsorted(end_b, groups) + 1)
        stop = np.cumsum([len(p.encode()) for p in parts])
        cuts = [np.concatenate(([0], np.searchsorted(e, stop, "right"))).tolist() for e in (end_a, end_b, groups, ends)]
        return [
            Aligned(a1 - a0, b1 - b0, g1 - g0, ";".join(shown[g0:g1]), links[l0:l1].tobytes())
            for (a0, a1), (b0, b1), (g0, g1), (l0, l1) in zip(*(zip(c, c[1:], strict=False) for c in cuts), strict=True)
        ]

    def _show(self, a: np.ndarray, b: np.ndarray, ends_a: np.ndarray, ends_b: np.ndarray) -> list[str]:
        names = self._names
        a_names, b_names = [names[i] for i in a.tolist()], [names[i] for i in b.tolist()]
        out, i, j = [], 0, 0
        for x, y in zip(ends_a.tolist(), ends_b.tolist(), strict=True):
            out.append(f"{','.join(a_names[i:x])}|{','.join(b_names[j:y])}")
            i, j = x, y
        return out


_aligners: dict[tuple[str, str], Aligner] = {}


def aligner(name_a: str = TOKENIZER_A, name_b: str = TOKENIZER_B) -> Aligner:
    """The worker's aligner for two tokenizer files, made once."""
    if (name_a, name_b) not in _aligners:
        _aligners[name_a, name_b] = Aligner(name_a, name_b)
    return _aligners[name_a, name_b]
