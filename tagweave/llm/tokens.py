"""Token ids by a public tokenizer, with a bounded cache.

Byte-level BPE never merges across the pieces its pattern splits a text into, so
a text's ids are its pieces' ids in a row. Texts of common Latin characters are
cut here, between pieces, and only what was not seen lately goes to the tokenizer's
model; any other text, and any that holds an added token, goes to the tokenizer
whole. Both ways give the same ids.
"""

from __future__ import annotations

import os
import re
from array import array
from codecs import charmap_decode
from collections.abc import Iterable, Iterator, Sequence

import numpy as np
import pyarrow as pa

TOKENIZER = "byte_bpe_50k.json"
# Chunks of a generation of the cache; two generations are kept.
CACHED_CHUNKS = 300_000
# Characters of texts that are encoded in one call.
CALL_CHARS = 2_000_000

# Characters whose class no Unicode version changed.
_UNUSUAL = re.compile(r"[^\t\n\r\x20-\x7e\xa1-ɏ]")
_LETTER = r"A-Za-z\xaa\xb5\xba\xc0-\xd6\xd8-\xf6\xf8-ɏ"
_DIGIT = r"0-9\xb2\xb3\xb9\xbc-\xbe"
_PIECE = re.compile(
    rf"'(?:s|t|re|ve|m|ll|d)| ?[{_LETTER}]+| ?[{_DIGIT}]+| ?[^\t\n\r {_LETTER}{_DIGIT}]+|[\t\n\r ]+(?![^\t\n\r ])|[\t\n\r ]+"
)

_WHITE_RUNS = ("  ", "\n\n", " \n", "\n ", "\t", "\r")

_encoders: dict[str, Encoder] = {}

# How byte-level vocabularies spell a byte: as itself where that is visible, the others from U+0100 on.
_VISIBLE = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
_HIDDEN = sorted({*range(0x100)} - {*_VISIBLE})
_SPELLED = "".join(chr(b if b in _VISIBLE else 0x100 + _HIDDEN.index(b)) for b in range(0x100))

_ALNUM = np.zeros(256, bool)
_ALNUM[list(b"0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz")] = True


def _piece_starts(data: np.ndarray, texts: Sequence[str], bounds: np.ndarray) -> np.ndarray:
    """Where texts, whose bytes stand in ``data`` in a row, may be cut between pieces."""
    starts = data == ord(" ")
    # Every single space begins a piece, and every single line end is one; a full
    # stop or comma belongs to no piece that holds a letter or digit.
    starts |= data == ord("\n")
    starts[1:] |= data[:-1] == ord("\n")
    starts[1:] |= ((data[1:] == ord(".")) | (data[1:] == ord(","))) & _ALNUM[data[:-1]]
    for text, begin, end in zip(texts, bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if any(x in text for x in _WHITE_RUNS):
            starts[begin:end] = False
            sizes = [len(piece.encode()) for piece in _PIECE.findall(text)]
            starts[begin + np.cumsum(sizes[:-1], dtype=np.int64)] = True
        if begin < end:
            starts[begin] = True
    return starts


def tokenizer_path(name: str) -> str:
    if os.sep in name:
        return name
    import public_tokenizers

    return public_tokenizers.path(name)


class Encoder:
    """Ids of texts as little-endian unsigned 32-bit integers.

    As the library does by default, the content of an added token inside a text,
    special or not, is that token's id.
    """

    def __init__(self, name: str) -> None:
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer

        self._tokenizer = Tokenizer.from_file(tokenizer_path(name))
        self._added = [t.content for t in self._tokenizer.get_added_tokens_decoder().values()]
        # Chunks met lately, in two generations: the older one is dropped whole.
        self._recent: dict[bytes, bytes] = {}
        self._older: dict[bytes, bytes] = {}
        self._model = self._tokenizer.model

    def direct(self, texts: Sequence[str]) -> list[bytes]:
        found = self._tokenizer.encode_batch_fast(list(texts), add_special_tokens=False)
        return [np.array(x.ids, dtype="<u4").tobytes() for x in found]

    def _learn(self, chunks: list[bytes]) -> None:
        """Merge what was not seen lately, piece by piece; the tokenizer's own cutting takes longer than its merges."""
        merge, known = self._model.tokenize, self._recent
        for chunk in chunks:
            ids = [t.id for piece in _PIECE.findall(chunk.decode()) for t in merge(charmap_decode(piece.encode(), "strict", _SPELLED)[0])]
            known[chunk] = array("I", ids).tobytes()

    def _is_whole(self, text: str) -> bool:
        return bool(_UNUSUAL.search(text)) or any(x in text for x in self._added)

    def _ids(self, chunks: list[bytes]) -> list[bytes]:
        """The ids of different chunks."""
        known = self._recent
        missing = [c for c in chunks if c not in known]
        older = self._older
        known.update((c, older[c]) for c in missing if c in older)
        if new := [c for c in missing if c not in older]:
            self._learn(new)
        return list(map(known.__getitem__, chunks))

    def encode_some(self, texts: Sequence[str]) -> list[bytes]:
        """The ids of each text; each different chunk of all of them is looked up once."""
        if len(self._recent) > CACHED_CHUNKS:
            self._older, self._recent = self._recent, {}
        is_whole = list(map(self._is_whole, texts))
        whole = iter(self.direct([text for text, w in zip(texts, is_whole, strict=True) if w]))
        cut = [text for text, w in zip(texts, is_whole, strict=True) if not w]
        data = list(map(str.encode, cut))
        bounds = np.cumsum([0, *map(len, data)])
        joined = np.frombuffer(b"".join(data), np.uint8)
        offsets = np.append(np.flatnonzero(_piece_starts(joined, cut, bounds)), len(joined)).astype(np.int32)
        chunks = pa.Array.from_buffers(pa.binary(), len(offsets) - 1, [None, pa.py_buffer(offsets), pa.py_buffer(joined)])
        chunks = chunks.dictionary_encode()
        found = pa.array(self._ids(chunks.dictionary.to_pylist()), pa.binary()).take(chunks.indices)
        # The ids of all texts stand in a row; a text's end where those of its last chunk do.
        places = np.frombuffer(found.buffers()[1], np.int32) if len(found) else np.zeros(1, np.int32)
        ids = memoryview(found.buffers()[2] or b"")
        ends = places[np.searchsorted(offsets, bounds)].tolist()
        each = iter([ids[a:b].tobytes() for a, b in zip(ends[:-1], ends[1:], strict=True)])
        return [next(whole if w else each) for w in is_whole]

    def encode(self, text: str) -> bytes:
        return self.encode_some([text])[0]

    def encode_all(self, texts: Iterable[str]) -> Iterator[bytes]:
        """The ids of each text in turn, by calls of about ``CALL_CHARS`` characters."""
        some, size = [], 0
        for text in texts:
            some.append(text)
            size += len(text)
            if size >= CALL_CHARS:
                yield from self.encode_some(some)
                some, size = [], 0
        yield from self.encode_some(some)


def encoder(name: str) -> Encoder:
    """The worker's encoder for a tokenizer file, made once."""
    if name not in _encoders:
        _encoders[name] = Encoder(name)
    return _encoders[name]
