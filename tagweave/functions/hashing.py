"""Hashes: a portable one for draws and shards, 64-bit ones for tokens."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tagweave.functions.arrow import map_distinct

# Constants of the published MurmurHash3 x64 128-bit algorithm.
MURMUR_C1 = 0x87C37B91114253D5
MURMUR_C2 = 0x4CF5AD432745937F
MURMUR_ADD1 = 0x52DCE729
MURMUR_ADD2 = 0x38495AB5
MURMUR_MIX1 = 0xFF51AFD7ED558CCD
MURMUR_MIX2 = 0xC4CEB9FE1A85EC53

_MASK = 0xFFFFFFFFFFFFFFFF


def stable_hash(key: Column, seed: int = 0) -> Column:
    """32 bits of the md5 of ``seed:key``; the same value in every engine."""
    digest = F.md5(F.concat(F.lit(f"{seed}:"), key.cast("string")))
    return F.conv(F.substring(digest, 1, 8), 16, 10).cast("long")


def uniform_draw(key: Column, seed: int = 0) -> Column:
    """A draw in [0, 1) that depends on the key and the seed only."""
    return stable_hash(key, seed) / F.lit(float(2**32))


def hash_tokens(tokens: Column, method: str = "xxhash64") -> Column:
    """Replace each token of an array by its 64-bit hash, keeping the order."""
    if method == "xxhash64":
        return F.transform(tokens, lambda t: F.xxhash64(t))
    return _murmur_tokens(tokens)


@F.arrow_udf(T.ArrayType(T.LongType()))
def _murmur_tokens(tokens: pa.Array) -> pa.Array:
    return map_distinct(tokens, murmur3_long, pa.int64())


def _rotate(x: int, bits: int) -> int:
    return ((x << bits) | (x >> (64 - bits))) & _MASK


def _finish(x: int) -> int:
    for factor in (MURMUR_MIX1, MURMUR_MIX2):
        x = ((x ^ (x >> 33)) * factor) & _MASK
    return x ^ (x >> 33)


def murmur3_bytes(data: bytes) -> int:
    """First 64 bits, as a signed number, of MurmurHash3 x64 128 with seed 0."""

    def scramble(lane: int, first: int, rotation: int, second: int) -> int:
        return (_rotate((lane * first) & _MASK, rotation) * second) & _MASK

    h1 = h2 = 0
    whole = len(data) - len(data) % 16
    for at in range(0, whole, 16):
        k1 = int.from_bytes(data[at : at + 8], "little")
        k2 = int.from_bytes(data[at + 8 : at + 16], "little")
        h1 = (_rotate(h1 ^ scramble(k1, MURMUR_C1, 31, MURMUR_C2), 27) + h2) & _MASK
        h1 = (h1 * 5 + MURMUR_ADD1) & _MASK
        h2 = (_rotate(h2 ^ scramble(k2, MURMUR_C2, 33, MURMUR_C1), 31) + h1) & _MASK
        h2 = (h2 * 5 + MURMUR_ADD2) & _MASK
    tail = data[whole:]
    if len(tail) > 8:
        h2 ^= scramble(int.from_bytes(tail[8:], "little"), MURMUR_C2, 33, MURMUR_C1)
    if tail:
        h1 ^= scramble(int.from_bytes(tail[:8], "little"), MURMUR_C1, 31, MURMUR_C2)
    h1 ^= len(data)
    h2 ^= len(data)
    h1 = (h1 + h2) & _MASK
    h2 = (h2 + h1) & _MASK
    low = (_finish(h1) + _finish(h2)) & _MASK
    return low - (1 << 64) if low >> 63 else low


def murmur3_long(token: str) -> int:
    """Hash of the token's UTF-16 code units."""
    return murmur3_bytes(token.encode("utf-16-le"))
