"""Periodic run detection by online dyadic square catching.

Words are appended to a stream. Scale k has blocks of m = 2^k words at the
multiples of m and is in charge of the periods m <= q < 2m:

* *Catchers.* A completed block becomes a catcher. The windows of m words that
  start in the next block are exactly those at a distance of its periods; each
  window that the appended words complete is compared with the catcher by its
  window hash (the hash of scale k + 1 comes from two hashes of scale k, so an
  appended word costs a few array operations a scale).
* *Squares.* A window that repeats the catcher's block at distance q is a
  suffix comparison under way: it is extended to the left once, and to the right
  by each appended word as long as words q apart are identical. All words are
  compared, so a hash never decides.
* *Runs.* Squares of one period that overlap are one stretch. When its first
  differing word (or the end) is there, the stretch is a run if it is long
  enough and no shorter period divides it.

A run of length >= 4q holds a block of scale k that recurs at distances q and
2q, whatever its start, so no run is missed. Inside a known run of period p,
blocks of 2p words recur at multiples of p only, so those squares are skipped
at once: a text that repeats one word costs no more than others.

One task works through its rows in pieces of about 4 MB of text; the words of a
piece form one stream, with a separator of its own between texts. Nothing is
shuffled; memory is bounded by a piece (or one longer text).
"""

from __future__ import annotations

import hashlib
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import Input, documents, pieces, utf8

#: A run has at least this many words and this many periods.
MIN_WORDS, MIN_PERIODS = 6, 4
#: Words appended at once.
CHUNK = 1 << 18
MULTIPLIER = 0x9E3779B97F4A7C15  # odd: a window's hash is a polynomial in it, modulo 2^64


def min_length(q: int) -> int:
    return max(MIN_WORDS, MIN_PERIODS * q)


class Scale:
    """Window hashes of m = 2^k words: those of the starts ``base, base + 1, ...`` that are still needed."""

    def __init__(self, k: int):
        self.m = 1 << k
        self.step = np.uint64(pow(MULTIPLIER, self.m, 1 << 64))
        self.base, self.hash = 0, np.zeros(0, np.uint64)

    @property
    def done(self) -> int:
        return self.base + len(self.hash)

    def trim(self) -> None:
        """Forget all but the windows of the current and the two blocks before."""
        keep = max(self.base, (self.done // self.m - 2) * self.m)
        self.hash, self.base = self.hash[keep - self.base :], keep


class SquareCatcher:
    """Runs of a stream of word ids: ``append`` words, then ``finish``; ``runs`` has (start, end, period).

    ``longest``: no run is longer than this many words (as texts end there),
    which bounds the periods that need catchers.
    """

    def __init__(self, longest: int):
        self.most = longest // MIN_PERIODS
        self.words = np.zeros(0, np.int64)
        self.cover = np.zeros(0, np.int64)  # end of a known run that holds the word
        self.cover_period = np.zeros(0, np.int64)
        self.scales = [Scale(k) for k in range(self.most.bit_length())]
        self.open: dict[int, list[int]] = {}  # period -> [start, compared up to]
        self.closed: dict[int, int] = {}  # period -> end of its last stretch
        self.runs: list[tuple[int, int, int]] = []

    def append(self, words: np.ndarray) -> None:
        new = len(words)
        self.words = np.concatenate([self.words, words])
        self.cover = np.concatenate([self.cover, np.zeros(new, np.int64)])
        self.cover_period = np.concatenate([self.cover_period, np.zeros(new, np.int64)])
        for q in list(self.open):
            self._advance(q)
        below = None
        for scale in self.scales:
            first = scale.done
            last = len(self.words) - scale.m + 1
            if last <= first:
                break
            if below is None:
                made = self.words[first:last].astype(np.uint64) * np.uint64(MULTIPLIER)
            else:
                at = first - below.base
                made = below.hash[at : at + last - first] * below.step + below.hash[at + below.m : at + below.m + last - first]
            scale.hash = np.concatenate([scale.hash, made])
            self._catch(scale, first, last)
            if below is not None:
                below.trim()
            below = scale
        if below is not None and below is self.scales[-1]:
            below.trim()

    def _catch(self, scale: Scale, first: int, last: int) -> None:
        """Compare the windows that start in [first, last) with the catcher of the block before theirs."""
        m, n = scale.m, len(self.words)
        start = np.arange(max(first, m), last)
        block = (start // m - 1) * m
        hit = scale.hash[start - scale.base] == scale.hash[block - scale.base]
        start, block = start[hit], block[hit]
        q = start - block
        # squares of runs go on for two more periods: a known word that differs there rules a run out
        beyond = block + 2 * q
        far = (beyond >= n) | (self.words[np.minimum(beyond, n - 1)] == self.words[block])
        # squares inside a known run of a period of half a block at most are its own
        inside = (self.cover[block] >= start + m) & (2 * self.cover_period[block] <= m)
        use = far & ~inside & (q <= self.most)
        for s, p in zip(block[use].tolist(), q[use].tolist()):
            if p in self.open or self.closed.get(p, 0) >= s + p + m:
                continue  # the same stretch
            left = self._same(s, s + p, -1, self.closed.get(p, p) - p)
            self.open[p] = [left, s + p]
            self._advance(p)

    def _same(self, a: int, b: int, way: int, limit: int) -> int:
        """From a and b outwards (way -1: to the left of both; 1: from both on) up to ``limit`` for the outer one.

        Returns the first position for a (left) or the end for b (right).
        """
        size, words = 32, self.words
        if way < 0:
            while a > max(limit, 0):
                n = min(size, a - max(limit, 0))
                differ = np.flatnonzero(words[a - n : a] != words[b - n : b])
                if len(differ):
                    return a - n + int(differ[-1]) + 1
                a, b, size = a - n, b - n, size * 4
            return a
        while b < limit:
            n = min(size, limit - b)
            differ = np.flatnonzero(words[a : a + n] != words[b : b + n])
            if len(differ):
                return b + int(differ[0])
            a, b, size = a + n, b + n, size * 4
        return b

    def _advance(self, q: int) -> None:
        """Suffix comparisons of period q over the words there are; the stretch closes at the first that differs."""
        start, upto = self.open[q]
        end = self._same(upto - q, upto, 1, len(self.words))
        self.open[q][1] = end
        run = end - start >= min_length(q) and self._primitive(start, q)
        if run:
            self.cover[start:end], self.cover_period[start:end] = end, q
        if end < len(self.words):
            self._close(q, run)

    def _close(self, q: int, run: bool) -> None:
        start, end = self.open.pop(q)
        self.closed[q] = end
        if run:
            self.runs.append((start, end, q))

    def _primitive(self, start: int, q: int) -> bool:
        """Whether no proper divisor of q is a period of the stretch (it has length >= 2q)."""
        left, r = q, 2
        factors = set()
        while r * r <= left:
            while left % r == 0:
                factors.add(r)
                left //= r
            r += 1
        factors |= {left} - {1}
        w = self.words[start : start + 2 * q]
        return not any(np.array_equal(w[q // f : q // f + q], w[:q]) for f in factors)

    def finish(self) -> None:
        for q in list(self.open):
            start, end = self.open[q]
            self._close(q, end - start >= min_length(q) and self._primitive(start, q))
        self.runs.sort(key=lambda r: (r[0], r[2]))


def planted(n: int, key: int) -> np.ndarray | None:
    """The word numbers that a text of ``n`` words has after the periodic tail that ``key`` plants; None: no change."""
    if key % 10 or not n:
        return None
    g = key // 10
    a = g % n
    p = 1 + (n - a) // (3 + g % 8)
    at = np.arange(n)
    at[a:] = a + (at[a:] - a) % p
    return at


def runs_of(texts: list[list]) -> list[list[tuple[int, int, int]]]:
    """Per text (a list of word ids as arrays): its runs as (start, length, period) by start, then period."""
    sizes = np.array([len(t) for t in texts], np.int64)
    catcher = SquareCatcher(int(sizes.max(initial=0)))
    stream = np.concatenate([np.concatenate([t, [-1 - i]]) for i, t in enumerate(texts)]) if texts else np.zeros(0, np.int64)
    for i in range(0, len(stream), CHUNK):
        catcher.append(stream[i : i + CHUNK])
    catcher.finish()
    begins = np.concatenate([[0], np.cumsum(sizes + 1)])
    out: list[list[tuple[int, int, int]]] = [[] for _ in texts]
    for start, end, q in catcher.runs:
        i = int(np.searchsorted(begins, start, "right")) - 1
        out[i].append((start - int(begins[i]), end - start, q))
    return out


FIELDS = [
    T.StructField("n_words", T.LongType()),
    T.StructField("n_runs", T.LongType()),
    T.StructField("start", T.LongType()),
    T.StructField("length", T.LongType()),
    T.StructField("period", T.LongType()),
    T.StructField("exponent_milli", T.LongType()),
    T.StructField("runs", T.ArrayType(T.ArrayType(T.LongType()))),
    T.StructField("runs_sha256", T.StringType()),
    T.StructField("collapsed", T.StringType()),
    T.StructField("collapsed_sha256", T.StringType()),
]


def described(words: list[bytes], runs: list[tuple[int, int, int]], with_text: bool) -> list:
    """The result row of one text."""
    dropped = np.zeros(len(words) + 1, np.int64)
    for s, n, q in runs:
        dropped[s + q] += 1
        dropped[s + n] -= 1
    if runs:
        gone = np.cumsum(dropped[:-1]) > 0
        words = [w for w, g in zip(words, gone.tolist()) if not g]
    best = max(runs, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
    collapsed = b" ".join(words)
    listed = "".join(f"{s},{n},{q}\n" for s, n, q in runs).encode()
    top = [*best, 1000 * best[1] // best[2]] if best else [None] * 4
    return [
        len(dropped) - 1, len(runs), *top, [list(r) for r in runs] if with_text else None,
        hashlib.sha256(listed).hexdigest(), collapsed.decode() if with_text else None, hashlib.sha256(collapsed).hexdigest(),
    ]


def _piece(texts: list[bytes], keys: list[int] | None, with_text: bool) -> list[list]:
    ids: dict[bytes, int] = {}
    streams, words_of = [], []
    for i, text in enumerate(texts):
        words = text.split()  # bytes: ASCII white space only
        at = planted(len(words), keys[i]) if keys else None
        if at is not None:
            words = [words[j] for j in at.tolist()]
        streams.append(np.fromiter((ids.setdefault(w, len(ids)) for w in words), np.int64, len(words)))
        words_of.append(words)
    return [described(w, r, with_text) for w, r in zip(words_of, runs_of(streams))]


def periodic_runs(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", plant: bool = False, with_text: bool = True
) -> DataFrame:
    """All rows of ``docs`` plus n_words, n_runs, start, length, period, exponent_milli, runs, runs_sha256, collapsed, collapsed_sha256.

    Words are split at ASCII white space and numbered from 0. ``runs``: every
    run as [start, length, period], by start, then period; a run has at least 6
    words and 4 of its smallest period, and neither neighbour keeps the period.
    ``start`` ... ``exponent_milli`` tell the run with the greatest
    length/period (ties: smallest start, then period), null without runs.
    ``collapsed``: the words that no run holds after its first period, joined by
    one space. Null text and texts without words have no run and the empty
    collapsed text. Rows are worked on one by one, so repeated rows give
    repeated results; an empty table gives an empty result.

    ``plant`` first makes the words of some texts periodic, as a test of recall
    (crc32 of the id as text decides; a null id counts as the empty text).
    ``with_text=False`` leaves ``runs`` and ``collapsed`` null.
    """
    src = Input(docs, id=id_col, text=text_col)
    key = F.crc32(F.coalesce(src["id"].cast("string"), F.lit("")).cast("binary"))
    source = src.df.select("*", key.alias("key"))
    text_at, key_at = src.inner.index(src.name("text")), len(src.inner)
    schema = T.StructType([*src.df.schema, *FIELDS])

    def run(batches):
        import pyarrow.compute  # noqa: F401  (pa.compute)
        from pyspark.sql.pandas.types import to_arrow_schema

        arrow = to_arrow_schema(schema)
        own = list(arrow)[key_at:]
        for batch in batches:
            for piece in pieces(batch, text_at):
                keys = piece.column(key_at).to_pylist() if plant else None
                made = _piece(utf8(piece.column(text_at)), keys, with_text)
                kept = [piece.column(i).cast(arrow.field(i).type) for i in range(key_at)]
                made = [pa.array([row[i] for row in made], f.type) for i, f in enumerate(own)]
                yield pa.RecordBatch.from_arrays([*kept, *made], schema=arrow)

    return src.restore(source.mapInArrow(run, schema), {f.name: f.name for f in FIELDS})


def op13_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = periodic_runs(documents(spark, sf_dir, "doc_id", "text"), plant=True, with_text=False)
    return found.select(
        "doc_id", "n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256"
    )
