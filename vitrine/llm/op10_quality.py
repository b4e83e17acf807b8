"""Quality classifier: a linear-chain conditional random field over a document's lines.

Each line that is not blank is labelled good or bad. Its features are character
classes, word shape and repetition of the line itself and of the lines before
and after it; transitions tie neighbouring labels. The score of a document is
the length-weighted mean of its lines' marginals for "good" (forward-backward),
put on a probability scale by a logistic fit.

The field is fitted on a bounded sample of labelled documents (``train_docs`` of
them by hash order, one text per id, each of at most ``train_lines`` lines, all
lines carrying their document's label); the sample's line features, not its texts, come to the
driver. Scoring reads every text whole, in Arrow batches, one pass, no shuffle.
"""

from __future__ import annotations

import unicodedata

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import Input, bounded_sample, crc_mod, documents, map_texts

#: Text scored at once: the arrays of a piece take about a hundred times its bytes.
PIECE_BYTES = 1 << 20

LETTER, UPPER, DIGIT, SPACE, POINT, SYMBOL = 1, 2, 4, 8, 16, 32
POINTS = ".,;:'\"!?()-’‘“”¿¡"
TABLE_END = 0x10000  # characters beyond count as letters
OWN = 16  # features of one line
_TABLES: dict[str, np.ndarray] = {}


def class_table() -> np.ndarray:
    if "c" not in _TABLES:
        table = np.full(TABLE_END + 1, LETTER, np.uint8)
        for c in range(TABLE_END):
            ch = chr(c)
            kind = unicodedata.category(ch)
            if ch.isspace():
                table[c] = SPACE
            elif kind[0] in "LM":
                table[c] = LETTER | (UPPER if kind in ("Lu", "Lt") else 0)
            elif kind[0] == "N":
                table[c] = DIGIT
            else:
                table[c] = POINT if ch in POINTS else SYMBOL
        _TABLES["c"] = table
        with np.errstate(over="ignore"):
            _TABLES["p"] = np.cumprod(np.full(64, 0x9E3779B97F4A7C15, np.uint64))
    return _TABLES["c"]


def line_features(texts: list[str]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features, lengths (characters without white space) and document index of all lines that are not blank."""
    table = class_table()
    joined = "\n".join(texts)
    cps = np.frombuffer((joined + "\n").encode("utf-32-le", "surrogatepass"), np.uint32)
    n = len(cps)
    kind = table[np.minimum(cps, TABLE_END)]
    ends = np.flatnonzero(cps == 10)
    starts = np.r_[0, ends[:-1] + 1]
    doc = np.repeat(np.arange(len(texts)), [t.count("\n") + 1 for t in texts])

    def count(mask: np.ndarray) -> np.ndarray:
        sums = np.r_[0, np.cumsum(mask, dtype=np.int32)]
        return (sums[ends] - sums[starts]).astype(np.float64)

    solid = kind != SPACE
    before = np.r_[False, solid[:-1]]
    word_start, word_end = solid & ~before, before & ~solid
    chars, words = count(solid), count(word_start)
    live = chars > 0
    at = np.flatnonzero(word_start)
    sizes = np.flatnonzero(word_end) - at
    last = kind[at + sizes - 1] if len(at) else np.empty(0, np.uint8)
    with np.errstate(over="ignore"):
        place = np.arange(n) - np.maximum.accumulate(np.where(word_start, np.arange(n), 0))
        mixed = np.where(solid, (cps.astype(np.uint64) + 1) * _TABLES["p"][place & 63], 0)
        hashes = np.add.reduceat(mixed, at) if len(at) else np.empty(0, np.uint64)
        hashes ^= hashes >> np.uint64(29)
        line_of = np.searchsorted(ends, at)
        pairs = np.unique(hashes * np.uint64(0x2545F4914F6CDD1D) + line_of.astype(np.uint64), return_index=True)[1]
    distinct = np.bincount(line_of[pairs], minlength=len(ends)).astype(np.float64)
    odd_ends = np.bincount(line_of, weights=(last & (LETTER | DIGIT)) == 0, minlength=len(ends))
    sums = np.zeros(len(ends), np.uint64)
    with np.errstate(over="ignore"):
        np.add.at(sums, line_of, hashes)
    same = np.r_[False, (sums[1:] == sums[:-1]) & (doc[1:] == doc[:-1])]
    letters = count((kind & LETTER) > 0)
    per_char, per_word, per_letter = (1 / np.maximum(x, 1) for x in (chars, words, letters))
    first = kind[np.minimum(starts, n - 1)]
    final = kind[np.maximum(ends - 1, 0)]
    own = np.stack(
        [
            np.log1p(chars) / 5,
            count((kind & UPPER) > 0) * per_letter,
            count((kind & DIGIT) > 0) * per_char,
            count((kind & SYMBOL) > 0) * per_char,
            np.sqrt(count((kind & SYMBOL) > 0) * per_char),
            count((kind & POINT) > 0) * per_char,
            count(cps == ord("!")) * per_char,
            np.minimum(chars * per_word, 30) / 10,
            odd_ends * per_word,
            distinct * per_word,
            (distinct * per_word) ** 4,
            count(solid & np.r_[False, cps[1:] == cps[:-1]]) * per_char,
            same.astype(np.float64),
            (words <= 2).astype(np.float64),
            (first & UPPER > 0).astype(np.float64),
            (final & POINT > 0).astype(np.float64),
        ],
        axis=1,
    )
    return own[live], chars[live], doc[live]


def with_neighbours(own: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """A line's own features, those of the line before and after (0 at a document's ends), two end marks, a constant."""
    if not len(own):
        return np.empty((0, 3 * OWN + 3))
    follows = np.r_[False, doc[1:] == doc[:-1]][:, None]
    leads = np.r_[follows[1:], [[False]]]
    earlier = np.r_[np.zeros((1, OWN)), own[:-1]] * follows
    later = np.r_[own[1:], np.zeros((1, OWN))] * leads
    return np.hstack([own, earlier, later, ~follows, ~leads, np.ones((len(own), 1))])


def forward_backward(emit: np.ndarray, doc: np.ndarray, trans: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """P(good) of every line, and the expected transition counts (2 x 2) summed over all chains.

    ``emit``: log-odds of good; ``doc``: chain of each line, ascending. Chains
    run side by side, longest first, one vector step per line.
    """
    n = len(emit)
    if not n:
        return np.empty(0), np.zeros((2, 2))
    starts = np.flatnonzero(np.r_[True, doc[1:] != doc[:-1]])
    sizes = np.diff(np.r_[starts, n])
    order = np.argsort(-sizes, kind="stable")
    starts, sizes = starts[order], sizes[order]
    active = np.searchsorted(-sizes, -np.arange(sizes[0]), side="left")  # chains longer than t
    e = np.stack([np.zeros(n), emit], 1)
    a, b = np.empty((n, 2)), np.zeros((n, 2))
    a[starts] = e[starts]
    for t in range(1, sizes[0]):
        i = starts[: active[t]] + t
        p = a[i - 1]
        a[i, 0] = np.logaddexp(p[:, 0] + trans[0, 0], p[:, 1] + trans[1, 0]) + e[i, 0]
        a[i, 1] = np.logaddexp(p[:, 0] + trans[0, 1], p[:, 1] + trans[1, 1]) + e[i, 1]
    for t in range(sizes[0] - 1, 0, -1):
        i = starts[: active[t]] + t
        q = b[i] + e[i]
        b[i - 1, 0] = np.logaddexp(trans[0, 0] + q[:, 0], trans[0, 1] + q[:, 1])
        b[i - 1, 1] = np.logaddexp(trans[1, 0] + q[:, 0], trans[1, 1] + q[:, 1])
    odds = (a + b)[:, 1] - (a + b)[:, 0]
    good = 0.5 * (1 + np.tanh(odds / 2))
    log_z = np.logaddexp((a + b)[:, 0], (a + b)[:, 1])
    inner = np.flatnonzero(np.r_[False, doc[1:] == doc[:-1]])
    pairs = a[inner - 1][:, :, None] + trans + (b + e)[inner][:, None, :] - log_z[inner][:, None, None]
    return good, np.exp(pairs).sum(0)


class Model:
    """Weights, feature scale, transitions, logistic scale of the document score, and the base rate."""

    def __init__(self, base: float = 0.5):
        self.base, self.weights = base, None

    def marginals(self, own: np.ndarray, doc: np.ndarray) -> np.ndarray:
        x = (with_neighbours(own, doc) - self.mean) / self.std
        return forward_backward(x @ self.weights, doc, self.trans)[0]

    def raw(self, own, size, doc, n: int) -> np.ndarray:
        """Length-weighted log-odds per document; not a number for documents without lines."""
        good = self.marginals(own, doc)
        total = np.bincount(doc, weights=size, minlength=n)
        with np.errstate(invalid="ignore"):
            share = np.bincount(doc, weights=size * good, minlength=n) / np.where(total > 0, total, np.nan)
        share = np.clip(share, 1e-4, 1 - 1e-4)
        return np.log(share / (1 - share))

    def scores(self, texts: list[str]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(texts), self.base)
        z = self.raw(*line_features(texts), len(texts))
        p = 1 / (1 + np.exp(-(self.slope * z + self.shift)))
        return np.where(np.isnan(z), self.base, p)


def _adam(gradient, start: np.ndarray, steps: int, rate: float) -> np.ndarray:
    w, m, v = start.copy(), np.zeros_like(start), np.zeros_like(start)
    for k in range(1, steps + 1):
        g = gradient(w)
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        w -= rate * (m / (1 - 0.9**k)) / (np.sqrt(v / (1 - 0.99**k)) + 1e-9)
    return w


def fit(docs: list[tuple[np.ndarray, np.ndarray, int]], steps: int = 150, ridge: float = 1e-3) -> Model:
    """Model from (own features, lengths, label) of each document; without both labels only the base rate."""
    labels = np.array([y for _, _, y in docs], float)
    model = Model(float(labels.mean()) if len(labels) else 0.5)
    docs = [d for d in docs if len(d[0])]
    labels = np.array([y for _, _, y in docs], float)
    if not len(labels) or labels.min() == labels.max():
        return model
    own, size = np.vstack([d[0] for d in docs]), np.concatenate([d[1] for d in docs])
    doc = np.repeat(np.arange(len(docs)), [len(d[0]) for d in docs])
    x = with_neighbours(own, doc)
    model.mean, model.std = x.mean(0), np.maximum(x.std(0), 1e-6)
    model.mean[-1], model.std[-1] = 0.0, 1.0
    x = (x - model.mean) / model.std
    y = labels[doc]
    weight = 1 / np.bincount(doc)[doc]  # every document counts once, however long
    inner = np.flatnonzero(np.r_[False, doc[1:] == doc[:-1]])
    seen = np.zeros((2, 2))
    np.add.at(seen, (y[inner - 1].astype(int), y[inner].astype(int)), 1)
    k = x.shape[1]

    def gradient(w: np.ndarray) -> np.ndarray:
        good, pairs = forward_backward(x @ w[:k], doc, w[k:].reshape(2, 2))
        to_weights = x.T @ ((good - y) * weight) / len(docs) + ridge * w[:k]
        return np.r_[to_weights, ((pairs - seen) / max(1, len(inner)) + ridge * w[k:].reshape(2, 2)).ravel()]

    w = _adam(gradient, np.zeros(k + 4), steps, 0.05)
    model.weights, model.trans = w[:k], w[k:].reshape(2, 2)
    z = model.raw(own, size, doc, len(docs))

    def logistic(v: np.ndarray) -> np.ndarray:
        r = 1 / (1 + np.exp(-(np.exp(v[0]) * z + v[1]))) - labels
        return np.array([(r * z).mean() * np.exp(v[0]) + 1e-3 * v[0], r.mean()])

    v = _adam(logistic, np.zeros(2), 300, 0.05)
    model.slope, model.shift = float(np.exp(v[0])), float(v[1])
    return model


def sample_features(docs: DataFrame, labels: DataFrame, train_docs: int, train_lines: int) -> list[tuple]:
    """Line features of the sampled documents; ``docs`` (id, text), ``labels`` (id, label), both for learning only."""
    agreed = labels.where("label is not null and id is not null").groupBy("id").agg(
        F.min("label").alias("label"), F.max("label").alias("other")
    )
    chosen = bounded_sample(agreed.where("label = other").select("id", "label"), "id", train_docs)
    joined = docs.join(F.broadcast(chosen), "id")
    pick = F.struct(F.xxhash64("text").alias("hash"), F.coalesce("text", F.lit("")).alias("text"))
    sample = (  # one row per chosen id, so repeated ids grow nothing; copies are combined before the exchange
        joined.groupBy("id").agg(F.min("label").alias("label"), F.min(pick).alias("pick"))
        .select("id", "label", F.col("pick.text").alias("text"))
    )
    fields = [T.StructField(c, T.BinaryType()) for c in ("own", "size")]

    def make():
        def features(column) -> list:
            own, size = [], []
            for t in column.to_pylist():
                f, s, _ = line_features([t or ""])
                short = len(s) <= train_lines
                own.append(f.astype("<f4").tobytes() if short else None)
                size.append(s.astype("<f4").tobytes() if short else None)
            return [own, size]

        return features

    rows = map_texts(sample, "text", ["id", "label"], fields, make).where("own is not null").collect()
    rows.sort(key=lambda r: (r["id"], r["own"]))
    return [
        (
            np.frombuffer(r["own"], "<f4").reshape(-1, OWN).astype(float),
            np.frombuffer(r["size"], "<f4").astype(float),
            int(r["label"]),
        )
        for r in rows
    ]


def quality(
    docs: DataFrame,
    labels: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    label_col: str = "quality",
    threshold: float = 0.3,
    train_docs: int = 4000,
    train_lines: int = 200,
) -> DataFrame:
    """All rows of ``docs`` plus score (0 to 1, higher is better) and predicted (1 if score >= ``threshold``).

    Fitted on labelled rows where ``learn`` (over column ``id``) holds; an id
    with contradicting or null labels is not learned from. A text that is null,
    empty or blank scores the sample's base rate; so does every text if the
    sample lacks one of the labels (0.5 without any sample). Repeated rows are
    scored each.
    """
    src = Input(docs, id=id_col, text=text_col)
    lab = Input(labels, id=id_col, label=label_col)
    known = lab.df.select(lab["id"].alias("id"), lab["label"].cast("int").alias("label")).where(learn)
    texts = src.df.select(src["id"].alias("id"), src["text"].alias("text"))
    model = fit(sample_features(texts, known, train_docs, train_lines))

    def make():
        def score(column) -> list:
            return [model.scores([t or "" for t in column.to_pylist()]).tolist()]

        return score

    scored = map_texts(src.df, src.name("text"), src.inner, [T.StructField("score", T.DoubleType())], make, PIECE_BYTES)
    return src.restore(scored, {"score": "score", "predicted": (F.col("score") >= threshold).cast("int")})


def learnable(col: Column) -> Column:
    """Rows that labels may be learned from; the others are held out."""
    return crc_mod(col, 5) != 0


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet").select("doc_id", "quality")
    scored = quality(documents(spark, sf_dir, "doc_id", "text"), labels, learnable(F.col("id")))
    return scored.select("doc_id", (~learnable(F.col("doc_id"))).alias("held_out"), "score", "predicted")
