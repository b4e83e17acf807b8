"""Odd rows and plain versions that the tests of the corpus operators share."""

import re

from xxhash import xxh64_intdigest

DDL = (
    "doc_id long, text string, lang string, source string, n_chars long, DOC_ID string, `Text` string, kept string,"
    " size string, score string, slot string, fp string, rid string, shard string, __in0 string"
)
LONG = ("word another third " * 30_000) + "end"

ROWS = [
    (1, "The same text here", "en", "a", 1),
    (2, "The same  text\there", "en", "a", 2),
    (3, "the same text here", "en", "b", None),
    (4, None, None, None, None),
    (5, "", "en", "b", 0),
    (6, " \t\n ", "fr", "é", 0),
    (7, LONG, "en", "a", 5),
    (7, LONG, "en", "a", 5),
    (8, "x" * 70_000, None, "c", 3),
    (None, "The same text here", "en", None, 9),
    (None, None, None, None, None),
    (9, "12345 67 $$$ ***", "de", "c", 2),
    (10, "Größe ÄÖÜ <|endoftext|> İstanbul 日本語 don't", "de", "c", 2),
    (11, "a\nb\n\nc", "fr", "b", 3),
    (12, "The same text here", "en", "b", 1),
]

SF_SMALL = "/root/testdata/sf0.001"
SF_ORACLE = "/root/testdata/sf0.01"


def plain_fingerprint(text: str | None, width: int = 3) -> int:
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + width]) for i in range(len(words) - width + 1)] or [" ".join(words)]
    h = [xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(prints: list[int], bits: int = 2) -> list[int]:
    """Index of the first member of each item's component."""
    parent = list(range(len(prints)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= bits:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return [find(i) for i in range(len(prints))]
