"""Repeatable random draws from a row key.

A draw depends on the key, the name of the draw and the seed only, so it is the same for any
partitioning, on a task retry and in another engine with MD5.
"""

from __future__ import annotations

import hashlib
import itertools
import math
from decimal import ROUND_HALF_UP, Decimal
from functools import reduce

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, functions as F


def bits(key: Column, name: str | Column, seed: int = 0) -> Column:
    """60 random bits as a number, for the draw called ``name``."""
    name = F.lit(name) if isinstance(name, str) else name
    text = F.md5(F.concat_ws("|", key.cast("string"), name, F.lit(str(seed))).cast("binary"))
    return F.conv(F.substring(text, 1, 15), 16, 10).cast("bigint")


def many_bits(key: Column, names: list[str], seed: int = 0) -> Column:
    """The same numbers as ``bits`` for all ``names``, as an array, drawn in batches."""
    @F.arrow_udf("array<bigint>")
    def draw(keys: pa.Array) -> pa.Array:
        drawn = draw_bits(keys, names, seed)
        return as_lists(pa.array(drawn.ravel()), len(names))

    return draw(key.cast("string"))


def as_lists(values: pa.Array, width: int) -> pa.Array:
    """``values`` in lists of ``width`` each."""
    rows = len(values) // max(width, 1)
    return pa.ListArray.from_arrays(pa.array(np.arange(rows + 1) * width, pa.int32()), values)


#: MD5 works on 64 bytes at a time; a text of so many bytes needs one such block.
ONE_BLOCK = 55
#: Texts whose digests are computed together: what a step reads and writes should stay in the processor's cache.
TOGETHER = 1 << 15
_SHIFTS = [[7, 12, 17, 22], [5, 9, 14, 20], [4, 11, 16, 23], [6, 10, 15, 21]]
_SINES = [int(abs(math.sin(i + 1)) * 2 ** 32) for i in range(64)]
_WORDS = [[i, (5 * i + 1) % 16, (3 * i + 5) % 16, 7 * i % 16][i // 16] for i in range(64)]
_START = [0x67452301, 0xefcdab89, 0x98badcfe, 0x10325476]


def draw_bits(keys: pa.Array, names: list[str], seed: int = 0) -> np.ndarray:
    """The numbers of ``bits`` in a worker: a row for every key text (or NULL) and a column for every name.

    Keys of one length make texts that differ in the same few words of MD5's block, so each step of it is done for a
    whole array of them at once.
    """
    tails = [f"{name}|{seed}".encode() for name in names]
    out = np.empty((len(keys), len(tails)), np.int64)
    none, bar = (pa.scalar(x, pa.large_string()) for x in ("", "|"))
    data, starts = _bytes_of(pc.fill_null(pc.binary_join_element_wise(keys.cast(pa.large_string()), none, bar), none))
    lengths = np.diff(starts)
    for length in np.unique(lengths):
        rows = np.flatnonzero(lengths == length)
        if length + max(map(len, tails), default=0) > ONE_BLOCK:
            heads = [data[starts[i]:starts[i] + length].tobytes() for i in rows]
            digests = b"".join([hashlib.md5(head + tail).digest()[:8] for head in heads for tail in tails])
            out[rows] = (np.frombuffer(digests, ">u8") >> 4).astype(np.int64).reshape(len(rows), -1)
            continue
        for start in range(0, len(rows), TOGETHER):
            some = rows[start:start + TOGETHER]
            heads = data[starts[some][:, None] + np.arange(length)]
            for size in {len(t) for t in tails}:
                alike = [i for i, t in enumerate(tails) if len(t) == size]
                for few in itertools.batched(alike, max(1, TOGETHER // len(some))):
                    out[np.ix_(some, few)] = _one_block(heads, [tails[i] for i in few]).T
    return out


def _bytes_of(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts (without NULL), and where each one starts and the last one ends."""
    texts = texts.cast(pa.large_binary())
    _, starts, data = texts.buffers()
    starts = np.frombuffer(starts, np.int64)[texts.offset:texts.offset + len(texts) + 1] if len(texts) else np.zeros(1, np.int64)
    return np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8), starts


def _one_block(heads: np.ndarray, tails: list[bytes]) -> np.ndarray:
    """The first 60 bits of the MD5 of each tail after each row of bytes, a row per tail.

    The tails are of one length; heads and tails together have at most ``ONE_BLOCK`` bytes.
    """
    rows, length = heads.shape
    n = len(tails) * rows
    mixed = -(-length // 4)    # words that hold bytes of the heads
    size = (8 * (length + len(tails[0]))).to_bytes(8, "little")
    rests = np.stack([np.frombuffer((t + b"\x80").ljust(56 - length, b"\0") + size, np.uint8) for t in tails])
    block = np.empty((len(tails), rows, 4 * mixed), np.uint8)
    block[:, :, :length] = heads
    block[:, :, length:] = rests[:, None, :4 * mixed - length]
    words = list(np.ascontiguousarray(block.view("<u4").reshape(n, mixed).T))
    for word in np.ascontiguousarray(rests[:, 4 * mixed - length:]).view("<u4").T:
        words.append(int(word[0]) if (word == word[0]).all() else np.repeat(word, rows))
    a, b, c, d = (np.full(n, x, np.uint32) for x in _START)
    f, shifted = np.empty(n, np.uint32), np.empty(n, np.uint32)
    for i in range(64):
        kind, word = i // 16, words[_WORDS[i]]
        if kind == 0:
            np.bitwise_xor(c, d, out=f)
            f &= b
            f ^= d
        elif kind == 1:
            np.bitwise_xor(b, c, out=f)
            f &= d
            f ^= c
        elif kind == 2:
            np.bitwise_xor(b, c, out=f)
            f ^= d
        else:
            np.invert(d, out=f)
            f |= b
            f ^= c
        a += f
        if isinstance(word, int):
            a += np.uint32((_SINES[i] + word) & 0xffffffff)
        else:
            a += word
            a += np.uint32(_SINES[i])
        by = _SHIFTS[kind][i % 4]
        np.left_shift(a, np.uint32(by), out=shifted)
        a >>= np.uint32(32 - by)
        a |= shifted
        a += b
        a, b, c, d = d, a, b, c
    a += np.uint32(_START[0])
    b += np.uint32(_START[1])
    return ((a.byteswap().astype(np.int64) << 28) | (b.byteswap() >> np.uint32(4))).reshape(len(tails), rows)


def plain_uniform(key: str, name: str, seed: int = 0) -> float:
    """The draw of ``uniform`` for one key, without Spark."""
    return int(hashlib.md5(f"{key}|{name}|{seed}".encode()).hexdigest()[:15], 16) / 2 ** 60


def as_uniform(drawn: Column) -> Column:
    """The bits as a number in [0, 1)."""
    return drawn.cast("double") / F.lit(float(2 ** 60))


def as_normal(drawn: Column) -> Column:
    """The bits as a nearly standard normal number: four 15-bit parts summed, centred and scaled."""
    parts = [F.shiftright(drawn, 15 * part).bitwiseAND(F.lit(2 ** 15 - 1)) for part in range(4)]
    return (reduce(lambda a, b: a + b, parts) / F.lit(float(2 ** 15)) - F.lit(2.0)) * F.lit(3.0 ** 0.5)


def normal_sums(drawn: np.ndarray) -> np.ndarray:
    """The sum of the four 15-bit parts of each number of bits, in a worker."""
    return sum((drawn >> 15 * part) & (2 ** 15 - 1) for part in range(4))


def normal_of(sums: np.ndarray) -> np.ndarray:
    """What ``as_normal`` makes of such sums."""
    return (sums / 2.0 ** 15 - 2.0) * 3.0 ** 0.5


def round_half_up(values: np.ndarray, decimals: int) -> np.ndarray:
    """Spark's ``round`` of doubles: halves of the shortest decimal form go away from zero."""
    scaled = np.abs(values) * 10.0 ** decimals
    whole = np.floor(scaled)
    out = np.copysign(whole + (scaled - whole >= 0.5), values) / 10.0 ** decimals + 0.0
    # Near a half, or beyond what the product holds exactly enough, the decimal form decides.
    for i in np.flatnonzero((np.abs(scaled - whole - 0.5) < 1e-6) | (scaled > 2.0 ** 30)):
        out[i] = Decimal(repr(float(values[i]))).quantize(Decimal(1).scaleb(-decimals), ROUND_HALF_UP)
    return out + 0.0


def uniform(key: Column, name: str | Column, seed: int = 0) -> Column:
    return as_uniform(bits(key, name, seed))


def percent_bucket(key: Column) -> Column:
    """0..99 from the first eight hex digits of the key's MD5."""
    hexes = F.md5(key.cast("string").cast("binary"))
    return F.conv(F.substring(hexes, 1, 8), 16, 10).cast("bigint") % F.lit(100)
