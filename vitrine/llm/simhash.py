"""64-bit SimHash fingerprints of word shingles, in Arrow batches."""

from __future__ import annotations

import numpy as np

BLOCK = 65_536  # shingles turned into bits at a time: long texts need no more memory than that


def fingerprint(text: bytes, width: int) -> int:
    """Majority of the bits of all shingles' XXH64 (seed 42), unsigned; 0 without words.

    A-Z is lower-cased; words are separated by ASCII white space; a text of
    fewer than ``width`` words is one shingle.
    """
    from xxhash import xxh64_intdigest

    words = text.lower().split()  # bytes: both touch ASCII only
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= width:
        return xxh64_intdigest(joined, 42)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1)
    starts = np.r_[0, ends[:-1]].tolist()
    stops = (ends[width - 1 :] - 1).tolist()
    n = len(stops)
    totals = np.zeros(64, np.int64)
    for i in range(0, n, BLOCK):
        h = [xxh64_intdigest(joined[a:b], 42) for a, b in zip(starts[i : i + BLOCK], stops[i : i + BLOCK])]
        bits = np.unpackbits(np.array(h, "<u8").view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        totals += bits.sum(0, dtype=np.int64)
    return int(np.packbits(totals * 2 > n, bitorder="little").view("<u8")[0])


def fingerprinter(width: int):
    from vitrine.llm.common import utf8

    def prints(column) -> list:
        made = [fingerprint(t, width) for t in utf8(column)]
        return [[f - (1 << 64) if f >> 63 else f for f in made]]

    return prints
