"""Directly addressable codes: ids split into chunk levels, with continuation bitmaps and rank directories.

Level 0 holds the low bits of every id; an id that does not fit has its continuation bit set there, and its next bits
stand in the next level, at the position that the number of set bits before it gives. A directory holds that number for
every 512 positions, so any id is found by one lookup per level, without decoding what stands before it.

Format of a block (all numbers little-endian): b"DAC1", u32 number of levels, u64 number of ids; then for each level u32
bits of a chunk (a power of two from 4 to 32), u64 number of chunks, the chunks (packed, low bits first, padded to 8
bytes), and, but for the last level, the bitmap (u64 words) and the directory (u64 per 512 positions).
"""

from __future__ import annotations

import struct

import numpy as np

MAGIC = b"DAC1"
#: Bits of the chunks in each level but the last, which takes what is left: 8 holds the 256 most frequent ids of byte-pair merges.
LEVEL_BITS = (8, 8, 16)
_STRIDE = 512


def _packed(chunks: np.ndarray, bits: int) -> bytes:
    if bits == 4:
        chunks = np.concatenate([chunks, np.zeros(len(chunks) % 2, dtype=chunks.dtype)])
        data = (chunks[0::2] | (chunks[1::2] << 4)).astype(np.uint8).tobytes()
    else:
        data = chunks.astype(f"<u{bits // 8}").tobytes()
    return data + b"\0" * (-len(data) % 8)


def encode(ids: np.ndarray, level_bits: tuple[int, ...] = LEVEL_BITS) -> bytes:
    """One block."""
    rest = np.asarray(ids, dtype=np.uint32)
    out, levels, total = [], 0, len(rest)
    for k, bits in enumerate(level_bits):
        more = (rest >> np.uint32(bits)) > 0 if bits < 32 else np.zeros(len(rest), dtype=bool)
        if k == len(level_bits) - 1 and more.any():
            raise ValueError(f"ids need more than {sum(level_bits)} bits")
        out.append(struct.pack("<IQ", bits, len(rest)))
        out.append(_packed(rest & np.uint32((1 << bits) - 1), bits))
        levels += 1
        if not more.any():
            break
        words = np.packbits(np.concatenate([more, np.zeros(-len(more) % 64, dtype=bool)]), bitorder="little")
        counts = np.add.reduceat(more, np.arange(0, len(more), _STRIDE))
        out.append(words.tobytes())
        out.append(np.concatenate([[0], np.cumsum(counts)[:-1]]).astype("<u8").tobytes())
        rest = rest[more] >> np.uint32(bits)
    return MAGIC + struct.pack("<IQ", levels, total) + b"".join(out)


class Block:
    """A block that is read in place: `block[i]` touches one chunk per level."""

    def __init__(self, data: bytes):
        if data[:4] != MAGIC:
            raise ValueError("not a block of directly addressable codes")
        count, self.total = struct.unpack_from("<IQ", data, 4)
        at, self.levels = 16, []
        for k in range(count):
            bits, n = struct.unpack_from("<IQ", data, at)
            at += 12
            size = (n * bits + 7) // 8
            chunks = np.frombuffer(data, np.uint8, size, at)
            chunks = chunks if bits == 4 else chunks.view(f"<u{bits // 8}")
            at += size + -size % 8
            bitmap = directory = None
            if k < count - 1:
                size = (n + 63) // 64 * 8
                bitmap = np.frombuffer(data, np.uint8, size, at)
                at += size
                size = (n + _STRIDE - 1) // _STRIDE
                directory = np.frombuffer(data, "<u8", size, at)
                at += 8 * size
            self.levels.append((bits, chunks, bitmap, directory))

    def __len__(self) -> int:
        return self.total

    def __getitem__(self, i: int) -> int:
        if not 0 <= i < self.total:
            raise IndexError(i)
        value, shift = 0, 0
        for bits, chunks, bitmap, directory in self.levels:
            chunk = int(chunks[i >> 1]) >> 4 * (i & 1) & 15 if bits == 4 else int(chunks[i])
            value |= chunk << shift
            if bitmap is None or not bitmap[i >> 3] >> (i & 7) & 1:
                break
            begin = i // _STRIDE * _STRIDE
            before = np.unpackbits(bitmap[begin >> 3 : (i >> 3) + 1], bitorder="little")[: i - begin]
            i = int(directory[i // _STRIDE]) + int(before.sum())
            shift += bits
        return value

    def slice(self, start: int, stop: int) -> np.ndarray:
        """The ids of a range: each level is entered at the rank of its first position."""
        out = np.zeros(stop - start, dtype=np.uint32)
        at, shift = np.arange(stop - start), 0
        for bits, chunks, bitmap, directory in self.levels:
            if bits == 4:
                own = chunks[start >> 1 : (stop + 1) >> 1]
                part = np.stack([own & 15, own >> 4], 1).ravel()[start & 1 :][: stop - start]
            else:
                part = chunks[start:stop]
            out[at] |= part.astype(np.uint32) << np.uint32(shift)
            if bitmap is None or start == stop:
                break
            begin = start // _STRIDE * _STRIDE
            bits_here = np.unpackbits(bitmap[begin >> 3 : (stop + 7) >> 3], bitorder="little")
            base = int(directory[start // _STRIDE]) + int(bits_here[: start - begin].sum())
            more = bits_here[start - begin : stop - begin].astype(bool)
            at, shift = at[more], shift + bits
            start, stop = base, base + int(more.sum())
        return out
