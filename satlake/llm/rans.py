"""Static range asymmetric numeral coding of id blocks, many interleaved states at a time.

A table gives every occurring id a frequency; the frequencies add up to
2^bits.  A block is coded on its own: id k belongs to state k mod lanes, all
states advance together, and whichever grows too large hands a 32-bit word to
the block's one stream, in the order in which the decoder will ask for them.
A state starts at LOW, so a decoder that does not end there has read a damaged
block.
"""

from __future__ import annotations

import struct
from zlib import crc32

import numpy as np

#: A state lies in [LOW, LOW << 32) between steps.
LOW = 1 << 31
LANES = 1024
#: A block has at least this many ids per state, or fewer states.
IDS_PER_LANE = 256


class FrequencyTable:
    """Frequencies of the occurring ids, shared by all blocks of a table."""

    _HEAD = struct.Struct("<4sBI")
    _MAGIC = b"RFQ1"

    def __init__(self, ids: np.ndarray, frequencies: np.ndarray, bits: int):
        self.bits, self.ids, self.frequencies = bits, ids.astype(np.uint32), frequencies.astype(np.uint32)
        ends = np.cumsum(frequencies, dtype=np.uint64)
        if len(ids) and int(ends[-1]) != 1 << bits:
            raise ValueError("frequencies do not fill the table")
        size = int(self.ids[-1]) + 1 if len(ids) else 0
        self.frequency_of = np.zeros(size, np.uint64)
        self.frequency_of[self.ids] = frequencies
        self.start_of = np.zeros(size, np.uint64)
        self.start_of[self.ids] = ends - self.frequencies
        self._id_at: np.ndarray | None = None

    @classmethod
    def from_counts(cls, counts: dict[int, int]) -> FrequencyTable:
        """One for each id that occurs, the rest in proportion; what is left over goes to the commonest."""
        ids = sorted(counts)
        bits = min(24, max(12, len(ids).bit_length() + 4))
        if len(ids) >= 1 << bits:
            raise ValueError("too many different ids for one table")
        spare, total = (1 << bits) - len(ids), sum(counts.values())
        shares = [1 + counts[i] * spare // total for i in ids]
        if ids:
            commonest = max(range(len(ids)), key=lambda k: counts[ids[k]])
            shares[commonest] += (1 << bits) - sum(shares)
        return cls(np.array(ids, np.uint32), np.array(shares, np.uint32), bits)

    @property
    def id_at(self) -> np.ndarray:
        """The id of each slot of the table."""
        if self._id_at is None:
            self._id_at = np.repeat(self.ids, self.frequencies)
        return self._id_at

    def to_bytes(self) -> bytes:
        body = self._HEAD.pack(self._MAGIC, self.bits, len(self.ids))
        body += self.ids.astype("<u4").tobytes() + self.frequencies.astype("<u4").tobytes()
        return body + struct.pack("<I", crc32(body))

    @classmethod
    def from_bytes(cls, data: bytes) -> FrequencyTable:
        magic, bits, n = cls._HEAD.unpack_from(data)
        if magic != cls._MAGIC or crc32(data[:-4]) != struct.unpack("<I", data[-4:])[0]:
            raise ValueError("not a frequency table, or a damaged one")
        numbers = np.frombuffer(data, "<u4", 2 * n, cls._HEAD.size)
        return cls(numbers[:n], numbers[n:], bits)


def _lanes(n: int) -> int:
    return max(1, min(LANES, n // IDS_PER_LANE))


def encode_block(ids: np.ndarray, table: FrequencyTable) -> bytes:
    """End states and words of one block; the number of ids is kept by the caller."""
    n = len(ids)
    if not n:
        return b""
    lanes = _lanes(n)
    bits, grow = np.uint64(table.bits), np.uint64(63 - table.bits)
    frequency, start = table.frequency_of[ids], table.start_of[ids]
    # x becomes x // f << bits | start + x % f, which is x + start + x // f * (2^bits - f).
    limit, step = frequency << grow, (np.uint64(1) << bits) - frequency
    states = np.full(lanes, LOW, np.uint64)
    words: list[np.ndarray] = []
    word = np.uint64(32)
    for at in range((n - 1) // lanes * lanes, -1, -lanes):
        now = slice(at, at + lanes)
        f = frequency[now]
        x = states[: len(f)]
        full = np.flatnonzero(x >= limit[now])
        grown = x[full]
        words.append(grown.astype("<u4"))
        x[full] = grown >> word
        whole = x // f
        whole *= step[now]
        x += start[now]
        x += whole
    words.reverse()
    return states.astype("<u8").tobytes() + np.concatenate(words).tobytes()


def decode_block(data: bytes, n: int, table: FrequencyTable) -> np.ndarray:
    """The ``n`` ids of a block."""
    ids = np.empty(n, np.uint32)
    if not n:
        return ids
    lanes = _lanes(n)
    states = np.frombuffer(data, "<u8", lanes).astype(np.uint64)
    words = np.frombuffer(data, "<u4", -1, 8 * lanes).astype(np.uint64)
    bits, mask, word = np.uint64(table.bits), np.uint64((1 << table.bits) - 1), np.uint64(32)
    id_at, frequency_of, start_of = table.id_at, table.frequency_of, table.start_of
    read = 0
    for at in range(0, n, lanes):
        out = ids[at : at + lanes]
        x = states[: len(out)]
        slot = x & mask
        np.take(id_at, slot.astype(np.int64), out=out, mode="clip")
        np.add(frequency_of[out] * (x >> bits), slot - start_of[out], out=x)
        low = np.flatnonzero(x < LOW)
        if len(low):
            x[low] = x[low] << word | words[read : read + len(low)]
            read += len(low)
    if read != len(words) or (states != LOW).any():
        raise ValueError("damaged block")
    return ids
