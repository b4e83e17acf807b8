"""Language ID with hyperdimensional profiles.

Each letter has a random vector of +1 and -1, drawn from a generator seeded with
its code point, so no alphabet is fixed. An n-gram's vector binds its letters'
vectors elementwise, each permuted once more per position to its right; a text's
vector bundles (adds) those of all its n-grams, a language's prototype those of
all its training texts. A text gets the language whose prototype has the largest
cosine. Letters are lower-cased; every run of other characters counts as one
boundary mark.

Texts are read in Arrow batches; each task adds up one vector per language, and
the partial sums are added by dimension with an ordinary grouped sum. Only the
prototypes (languages x dimensions, languages checked against a bound) go to the
driver and back to the tasks. N-gram vectors are kept per worker up to a bound.
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import Input, crc_mod, documents, map_texts, pieces

UNDETERMINED = "und"
KEPT_VECTORS = 16_384  # n-gram vectors a worker keeps
_LETTER_CLASS: dict[str, np.ndarray] = {}


def letter_table() -> np.ndarray:
    """Lower-case code point of every letter, 0 for every other character."""
    if "t" not in _LETTER_CLASS:
        table = np.zeros(0x110000, np.int32)
        for c in range(0x110000):
            ch = chr(c)
            if ch.isalpha():
                low = ch.lower()
                table[c] = ord(low[0])
        _LETTER_CLASS["t"] = table
    return _LETTER_CLASS["t"]


def ngram_codes(text: str, n: int) -> np.ndarray:
    """Codes (21 bits a letter) of the n-grams of a text that hold a letter; letters only, one mark between words."""
    letters = letter_table()[np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)]
    if not letters.any():
        return np.empty(0, np.int64)
    mark = letters == 0
    keep = ~(mark & np.r_[True, mark[:-1]])
    seq = np.r_[0, letters[keep], 0].astype(np.int64) if not mark[-1] else np.r_[0, letters[keep]].astype(np.int64)
    if len(seq) < n:
        seq = np.r_[seq, np.zeros(n - len(seq), np.int64)]
    codes = np.zeros(len(seq) - n + 1, np.int64)
    for k in range(n):
        codes = codes << 21 | seq[k : len(seq) - n + 1 + k]
    return codes


class Space:
    """Letter and n-gram vectors of one seed."""

    def __init__(self, dims: int, n: int, seed: int):
        self.dims, self.n, self.seed = dims, n, seed
        self.order = np.random.default_rng([seed, 1]).permutation(dims)
        self.letters: dict[int, list[np.ndarray]] = {}
        self.codes, self.vectors = np.empty(0, np.int64), np.empty((0, dims), np.float32)

    def letter(self, c: int, times: int) -> np.ndarray:
        """The letter's vector, permuted ``times`` times."""
        if c not in self.letters:
            v = np.random.default_rng([self.seed, 2, c]).choice(np.array([-1, 1], np.int8), self.dims)
            turns = [v]
            for _ in range(self.n - 1):
                turns.append(turns[-1][self.order])
            self.letters[c] = turns
        return self.letters[c][times]

    def bind(self, code: int) -> np.ndarray:
        out = np.ones(self.dims, np.int8)
        for k in range(self.n):
            out = out * self.letter((code >> 21 * k) & 0x1FFFFF, k)
        return out

    def table(self, codes: np.ndarray) -> np.ndarray:
        """Vectors of the sorted distinct ``codes``."""
        new = np.setdiff1d(codes, self.codes, assume_unique=True)
        made = np.array([self.bind(c) for c in new.tolist()], np.float32).reshape(-1, self.dims)
        if len(new) and len(self.codes) + len(new) <= KEPT_VECTORS:
            at = np.searchsorted(self.codes, new)
            self.codes, self.vectors = np.insert(self.codes, at, new), np.insert(self.vectors, at, made, axis=0)
            new = new[:0]
        if not len(new):
            return self.vectors[np.searchsorted(self.codes, codes)]
        out = np.empty((len(codes), self.dims), np.float32)
        old = ~np.isin(codes, new, assume_unique=True)
        out[old] = self.vectors[np.searchsorted(self.codes, codes[old])]
        out[~old] = made
        return out

    def bundle(self, text: str) -> np.ndarray | None:
        codes = ngram_codes(text, self.n)
        if not len(codes):
            return None
        distinct, counts = np.unique(codes, return_counts=True)
        out = np.zeros(self.dims, np.float32)
        for i in range(0, len(distinct), 4096):  # bounded memory for texts with very many n-grams
            out += counts[i : i + 4096].astype(np.float32) @ self.table(distinct[i : i + 4096])
        return out


_SPACES: dict[tuple, Space] = {}


def space(dims: int, n: int, seed: int) -> Space:
    return _SPACES.setdefault((dims, n, seed), Space(dims, n, seed))


def prototypes(
    docs: DataFrame, text: str, lang: str, dims: int, n: int, seed: int, max_languages: int
) -> tuple[list[str], np.ndarray]:
    """Languages in order and their prototype vectors, from rows with a language."""

    def partial_sums(batches):
        import pyarrow as pa
        import pyarrow.compute  # noqa: F401

        sums: dict[str, np.ndarray] = {}
        hyper = space(dims, n, seed)
        for batch in batches:
            for piece in pieces(batch, 0):
                counts: dict[str, list[np.ndarray]] = {}
                for t, la in zip(piece.column(0).to_pylist(), piece.column(1).to_pylist()):
                    if t:
                        counts.setdefault(la, []).append(ngram_codes(t, n))
                for la, codes in counts.items():  # bundling is a sum: count first, then one product per language
                    distinct, times = np.unique(np.concatenate(codes), return_counts=True)
                    total = sums.setdefault(la, np.zeros(dims))
                    for i in range(0, len(distinct), 4096):
                        total += times[i : i + 4096].astype(np.float32) @ hyper.table(distinct[i : i + 4096])
        if sums:
            yield pa.RecordBatch.from_arrays(
                [pa.array(list(sums)), pa.array([v.tolist() for v in sums.values()], pa.list_(pa.float64()))],
                names=["lang", "sums"],
            )

    rows = docs.select(text, lang).mapInArrow(partial_sums, "lang string, sums array<double>")
    added = (
        rows.select("lang", F.posexplode("sums").alias("dim", "part"))
        .groupBy("lang", "dim")
        .agg(F.sum("part").alias("part"))
    )
    found = docs.groupBy(lang).agg(F.lit(1)).limit(max_languages + 1).count()
    if found > max_languages:
        raise ValueError(f"more than {max_languages} languages in {lang!r}; raise max_languages if they are real")
    got = added.collect()  # languages x dims numbers
    names = sorted({r["lang"] for r in got})
    out = np.zeros((len(names), dims))
    at = {la: i for i, la in enumerate(names)}
    for r in got:
        out[at[r["lang"]], r["dim"]] = r["part"]
    return names, out


def language_id(
    docs: DataFrame,
    learn: Column,
    id_col: str = "doc_id",
    text_col: str = "text",
    lang_col: str = "lang",
    dims: int = 1024,
    n: int = 3,
    seed: int = 7,
    max_languages: int = 1000,
) -> DataFrame:
    """All rows of ``docs`` plus lang_pred and score, learned from rows where ``learn`` holds.

    ``learn`` may use the columns ``id`` and ``text``. Rows with a null language
    are not learned from. score is the cosine with the chosen prototype, 0 if
    negative. A text that is null or has no letter gets ``und`` and score 0, and
    so does every text if nothing could be learned. Equal cosines go to the
    language that sorts first. Repeated rows are learned and predicted each.
    """
    src = Input(docs, id=id_col, text=text_col, lang=lang_col)
    known = src.df.withColumns({"id": src["id"], "text": src["text"]}).where(learn & src["lang"].isNotNull())
    names, proto = prototypes(
        known.select("text", src["lang"].alias("lang")), "text", "lang", dims, n, seed, max_languages
    )
    norms = np.linalg.norm(proto, axis=1, keepdims=True)
    unit = (proto / np.where(norms > 0, norms, 1)).astype(np.float32)

    def make():
        hyper = space(dims, n, seed)

        def predict(column) -> list:
            langs, scores = [], []
            for t in column.to_pylist():
                v = hyper.bundle(t) if t and names else None
                size = float(np.linalg.norm(v)) if v is not None else 0.0
                if not size:
                    langs.append(UNDETERMINED)
                    scores.append(0.0)
                    continue
                cos = unit @ v / size
                k = int(np.argmax(cos))
                langs.append(names[k])
                scores.append(min(1.0, max(0.0, float(cos[k]))))
            return [langs, scores]

        return predict

    fields = [T.StructField("lang_pred", T.StringType()), T.StructField("score", T.DoubleType())]
    out = map_texts(src.df, src.name("text"), src.inner, fields, make)
    return src.restore(out, {"lang_pred": "lang_pred", "score": "score"})


def op2_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir, "doc_id", "text", "lang")
    held_out = crc_mod(F.col("doc_id"), 3) == 1
    learned = language_id(docs, learn=crc_mod(F.col("id"), 3) != 1)
    return learned.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")
