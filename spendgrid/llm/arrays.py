"""Texts of an Arrow column as flat byte arrays, and hashes of many spans at once."""

import numpy as np
import pyarrow as pa

CHUNK_BYTES = 1 << 20

# A word is a run of bytes other than space and 0x09 to 0x0D.
SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

# Two primes below 2^31 with a base each: products of two residues fit 64 bits, and unlike
# arithmetic modulo 2^64 there is no short text that collides whatever the base is.
_PRIMES = np.array([2147483647, 2147483629], np.uint64)
_rng = np.random.default_rng(7)
_BASES = [int(x) for x in _rng.integers(1 << 29, 1 << 30, 2)]
_INVERSES = [pow(b, -1, int(p)) for b, p in zip(_BASES, _PRIMES)]
_BYTE = _rng.integers(1 << 29, 1 << 30, (2, 256), dtype=np.uint64)
_powers = np.ones((4, 1), np.uint64)


def mix(x):
    """A bijection of 64-bit numbers that spreads every bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def byte_chunks(column, limit=CHUNK_BYTES):
    """(first row, end row, bytes, offsets) of runs of rows with at most `limit` bytes, or of one row.

    Null texts are empty. Offsets start at 0 within the bytes returned.
    """
    if not len(column):
        return
    column = column.fill_null(b"" if pa.types.is_binary(column.type) else "")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, ends, data = column.buffers()
    offsets = np.frombuffer(ends, np.int64 if wide else np.int32)[column.offset : column.offset + len(column) + 1].astype(np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < len(column):
        end = int(np.searchsorted(offsets, offsets[first] + limit, "right")) - 1
        end = min(max(end, first + 1), len(column))
        yield first, end, data[offsets[first] : offsets[end]], offsets[first : end + 1] - offsets[first]
        first = end


def powers(n):
    """The first n powers of both bases, and of their inverses."""
    global _powers
    if _powers.shape[1] < n:
        n = max(n, CHUNK_BYTES + 2)
        out = np.ones((4, n), np.uint64)
        for row, base in enumerate([*_BASES, *_INVERSES]):
            prime, known, step = _PRIMES[row % 2], 1, base
            while known < n:  # every round doubles what is known
                end = min(2 * known, n)
                out[row, known:end] = out[row, : end - known] * np.uint64(step) % prime
                known, step = 2 * known, step * step % int(prime)
        _powers = out
    return _powers


class SpanHash:
    """64-bit hashes of spans of a byte array; equal bytes give equal hashes wherever they stand.

    Two polynomials modulo primes just below 2^31, so 62 bits tell spans apart.
    """

    def __init__(self, data):
        up = powers(len(data) + 1)
        self.down = up[2:]
        self.sums = np.zeros((2, len(data) + 1), np.uint64)
        for i in range(2):  # residues below 2^31: the sum of 2^32 of them fits
            np.cumsum(_BYTE[i][data] * up[i, : len(data)] % _PRIMES[i], out=self.sums[i, 1:])

    def __call__(self, starts, ends):
        both = [(s[ends] - s[starts]) % p * d[starts] % p for s, p, d in zip(self.sums, _PRIMES, self.down)]
        return mix(((both[0] << np.uint64(32)) | both[1]) + mix((ends - starts).astype(np.uint64)))

    def windows(self, width):
        """The hashes of all spans of this width, by their start."""
        n = self.sums.shape[1] - width
        both = [(s[width:] - s[:n]) % p * d[:n] % p for s, p, d in zip(self.sums, _PRIMES, self.down)]
        return mix(((both[0] << np.uint64(32)) | both[1]) + mix(np.array([width], np.uint64)))


def row_of(positions, offsets):
    """The row that holds each position."""
    return np.searchsorted(offsets, positions, "right") - 1


def word_spans(data, offsets):
    """Starts, ends and rows of all words; no word crosses a row."""
    word = ~SPACE[data]
    opens, closes = word.copy(), word.copy()
    if len(data):
        opens[1:] &= ~word[:-1]
        closes[:-1] &= ~word[1:]
        inner = offsets[(offsets > 0) & (offsets < len(data))]
        opens[inner] = word[inner]
        closes[inner - 1] = word[inner - 1]
    starts = np.flatnonzero(opens)
    return starts, np.flatnonzero(closes) + 1, row_of(starts, offsets)


def ranges(starts, lengths):
    """The numbers of all ranges [start, start + length), one after another."""
    total = int(lengths.sum())
    if not total:
        return np.zeros(0, np.int64)
    before = np.cumsum(lengths) - lengths
    return np.arange(total) + np.repeat(starts - before, lengths)
