"""BPE encoding and decoding by speculate and verify.

A word's tokens are first guessed by greedy longest match. A sequence of tokens
is the result of byte-pair merging exactly if every adjacent pair, merged alone,
gives that pair again (and a lone token gives itself): merges are taken in a
fixed order, so whatever would go wrong goes wrong at one boundary. The pairs of
all new words of a batch are checked together against a sorted table of pair
verdicts (one binary search for all); pairs not seen before get their verdict by
merging just these two. Only words with a failing pair are merged exactly.

For byte-level BPE files with a word-end mark, whose normaliser is NFC, white
space and lower case, and whose pre-tokenizer splits contractions, letters,
single digits and other runs. Texts in Latin script are split here; the
library's own normaliser and pre-tokenizer split the rest, so that rules which
depend on the Unicode version agree with it.
"""

from __future__ import annotations

import heapq
import json
import re
import unicodedata

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import Input, documents, map_texts

LATIN_END = 0x250
CACHE_WORDS = 300_000  # of two generations together
CACHED_PAIRS = 1_000_000  # pair verdicts that a worker keeps
CACHED_LENGTH = 64
SHORT = 32


def byte_letters() -> list[str]:
    """The printable stand-in of each byte: itself if printable, else the next free code point from 256."""
    printable = {*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)}
    out, free = [], 256
    for b in range(256):
        out.append(chr(b if b in printable else free))
        free += b not in printable
    return out


def _latin_pattern() -> re.Pattern:
    def group(test) -> str:
        return "".join(f"\\x{c:02x}" if c < 256 else chr(c) for c in range(LATIN_END) if test(c))

    letters = group(lambda c: unicodedata.category(chr(c))[0] == "L")
    numbers = group(lambda c: unicodedata.category(chr(c))[0] == "N")
    space = r"\t-\r \x85\xa0"
    return re.compile(f"'s|'t|'re|'ve|'m|'ll|'d|[{letters}]+|[{numbers}]|[^{space}{letters}{numbers}]+")


class Bpe:
    """Vocabulary, merge ranks, pair verdicts and a bounded word cache of one tokenizer file."""

    def __init__(self, path: str):
        with open(path, encoding="utf-8") as f:
            spec = json.load(f)
        model = spec["model"]
        if model["type"] != "BPE" or not model.get("end_of_word_suffix") or model.get("byte_fallback"):
            raise ValueError(f"{path}: not a byte-level BPE file with a word-end mark")
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.end: str = model["end_of_word_suffix"]
        self.vocab: dict[str, int] = model["vocab"]
        self.names = {i: t for t, i in self.vocab.items()}
        merges = [tuple(m.split(" ") if isinstance(m, str) else m) for m in model["merges"]]
        self.rank = {m: i for i, m in enumerate(merges)}
        self.longest: dict[str, int] = {}  # of the tokens that begin with these two letters (or one)
        for t in self.vocab:
            bare = t.removesuffix(self.end)
            for start in {bare[:1], bare[:2]}:
                self.longest[start] = max(len(bare), self.longest.get(start, 1))
        self.letters = byte_letters()
        self.letter_table = dict(enumerate(self.letters))
        self.words = _latin_pattern()
        self.special = {t["content"]: t["id"] for t in spec.get("added_tokens", [])}
        self.names |= {i: t for t, i in self.special.items()}
        by_length = sorted(self.special, key=len, reverse=True)
        self.special_at = re.compile("(" + "|".join(map(re.escape, by_length)) + ")") if by_length else None
        self.codes = np.empty(0, np.int64)  # checked pairs, sorted
        self.good = np.empty(0, bool)
        self.cache: dict[str, tuple[bytes, str]] = {}
        self.older: dict[str, tuple[bytes, str]] = {}  # the generation before; what is used again moves up
        self.failed = self.seen = 0

    # ------------------------------------------------------------ one word

    def symbols(self, letters: str) -> list[str]:
        return [*letters[:-1], letters[-1] + self.end]

    def greedy(self, letters: str) -> list[int]:
        """Longest match from the left; the last token carries the word-end mark."""
        out, i, n, vocab, longest = [], 0, len(letters), self.vocab, self.longest
        marked = letters + self.end
        while i < n:
            j = i + longest.get(letters[i : i + 2], 1)
            t = vocab.get(marked[i:]) if j >= n else None
            if t is not None:
                out.append(t)
                break
            j = min(j, n - 1)
            while j > i and (t := vocab.get(letters[i:j])) is None:
                j -= 1
            out.append(t)
            i = j
        return out

    def merge(self, symbols: list[str]) -> list[int]:
        """Exact merging: the pair of lowest rank first, the leftmost of equal ones."""
        return self._merge_short(symbols) if len(symbols) <= SHORT else self._merge_long(symbols)

    def _merge_short(self, sym: list[str]) -> list[int]:
        rank, none = self.rank.get, len(self.rank)
        ranks = [rank(p, none) for p in zip(sym, sym[1:])]
        while ranks and (r := min(ranks)) < none:
            i = ranks.index(r)
            sym[i : i + 2] = [sym[i] + sym[i + 1]]
            del ranks[i]
            if i:
                ranks[i - 1] = rank((sym[i - 1], sym[i]), none)
            if i < len(ranks):
                ranks[i] = rank((sym[i], sym[i + 1]), none)
        return [self.vocab[s] for s in sym]

    def _merge_long(self, symbols: list[str]) -> list[int]:
        """The same with a heap: n log n for words of any length."""
        sym: list[str | None] = list(symbols)
        n = len(sym)
        right, left = list(range(1, n + 1)), list(range(-1, n - 1))
        heap = [(r, i, sym[i], sym[i + 1]) for i in range(n - 1) if (r := self.rank.get((sym[i], sym[i + 1]))) is not None]
        heapq.heapify(heap)
        while heap:
            _, i, a, b = heapq.heappop(heap)
            j = right[i]
            if sym[i] != a or j >= n or sym[j] != b:
                continue
            sym[i], sym[j] = a + b, None
            right[i] = right[j]
            if right[i] < n:
                left[right[i]] = i
            for p in (left[i], i):
                q = right[p] if p >= 0 else n
                if p >= 0 and q < n and (r := self.rank.get((sym[p], sym[q]))) is not None:
                    heapq.heappush(heap, (r, p, sym[p], sym[q]))
        return [self.vocab[s] for s in sym if s is not None]

    # ------------------------------------------------------------ all words

    def _alone(self, code: int) -> bool:
        """Whether merging the pair (or, for a first half of 0, the one token) alone gives it again."""
        a, b = (code >> 32) - 1, code & 0xFFFFFFFF
        ids = [b] if a < 0 else [a, b]
        text = "".join(self.names[i] for i in ids)
        ends = text.endswith(self.end)
        return self.merge(self.symbols(text.removesuffix(self.end)) if ends else list(text)) == ids

    def verdicts(self, codes: np.ndarray) -> np.ndarray:
        new = np.setdiff1d(codes, self.codes)
        if len(self.codes) + len(new) > CACHED_PAIRS:  # starts anew, so that a long-lived worker stays small
            self.codes, self.good = np.empty(0, np.int64), np.empty(0, bool)
            new = np.unique(codes)
        if len(new):
            good = np.fromiter(map(self._alone, new.tolist()), bool, len(new))
            at = np.searchsorted(self.codes, new)
            self.codes, self.good = np.insert(self.codes, at, new), np.insert(self.good, at, good)
        return self.good[np.searchsorted(self.codes, codes)]

    def encode_words(self, letters: list[str]) -> list[list[int]]:
        """Token ids of words given in byte letters."""
        guess = [self.greedy(w) for w in letters]
        flat = np.fromiter((t for g in guess for t in g), np.int64)
        word = np.repeat(np.arange(len(guess)), [len(g) for g in guess])
        first = np.r_[True, word[1:] != word[:-1]] if len(word) else np.empty(0, bool)
        last = np.r_[first[1:], True] if len(word) else first
        before = np.where(first, -1, np.r_[-1, flat[:-1]]) if len(word) else flat
        check = ~first | (first & last)  # every adjacent pair, and words of one token
        bad = ~self.verdicts(((before + 1) << 32 | flat)[check])
        failing = np.unique(word[check][bad])
        for i in failing.tolist():
            guess[i] = self.merge(self.symbols(letters[i]))
        self.seen += len(guess)
        self.failed += len(failing)
        return guess

    def split(self, text: str) -> list[str]:
        """Keys of the words of a text: the word itself, a space and byte letters, or a line end and a special token.

        Words never hold white space, so the three kinds cannot meet.
        """
        out: list[str] = []
        for k, part in enumerate(self.special_at.split(text) if self.special_at else [text]):
            if k % 2:
                out.append("\n" + part)
            elif part.isascii() or max(max(part), max(low := part.lower())) < chr(LATIN_END):
                out += self.words.findall(part.lower() if part.isascii() else low)
            else:
                norm = self.tok.normalizer.normalize_str(part)
                out += [" " + p for p, _ in self.tok.pre_tokenizer.pre_tokenize_str(norm)]
        return out

    def letters_of(self, key: str) -> str:
        if key[0] == " ":
            return key[1:]
        if key.isascii() and key.isprintable():  # each byte is its own stand-in
            return key
        return key.encode().decode("latin-1").translate(self.letter_table)

    def lookup(self, texts: list[list[str]]) -> dict[str, tuple[bytes, str]]:
        """(ids as little-endian uint32, token strings) for every key."""
        missing = set().union(*texts).difference(self.cache)
        if len(self.cache) + len(missing) > CACHE_WORDS // 2:
            self.older, self.cache = self.cache, {}
            missing = set().union(*texts)
        known = missing & self.older.keys()
        self.cache.update((w, self.older[w]) for w in known)
        new = sorted(missing - known)
        special = [w for w in new if w[0] == "\n"]
        words = [w for w in new if w[0] != "\n"]
        found = {w: [self.special[w[1:]]] for w in special}
        found |= dict(zip(words, self.encode_words([self.letters_of(w) for w in words])))
        ids = np.fromiter((i for g in found.values() for i in g), "<u4").tobytes()
        made, at, name = {}, 0, self.names.__getitem__
        for w, g in found.items():
            made[w] = ids[at : at + 4 * len(g)], " ".join(map(name, g))
            at += 4 * len(g)
        long = {w: v for w, v in made.items() if len(w) > CACHED_LENGTH}
        self.cache.update((w, v) for w, v in made.items() if w not in long)
        return {**self.cache, **long} if long else self.cache


_LOADED: dict[str, Bpe] = {}


def coder(path: str):
    """Function from an Arrow string array to (n_tokens, ids, decoded)."""
    bpe = _LOADED.get(path) or _LOADED.setdefault(path, Bpe(path))

    def code(column) -> list:
        texts = [bpe.split(t) if t else [] for t in column.to_pylist()]
        got = bpe.lookup(texts)
        ids = [b"".join([got[w][0] for w in t]) for t in texts]
        return [[len(i) // 4 for i in ids], ids, [" ".join([got[w][1] for w in t]) for t in texts]]

    return code


def encode_decode(docs: DataFrame, tokenizer_path: str, keep: list[str], text_col: str = "text") -> DataFrame:
    """``keep`` columns of every row plus n_tokens, token_ids (little-endian uint32) and decoded.

    Ids are the library's without special tokens added (special strings inside
    a text give their token); decoded is its decode with special tokens kept.
    Null counts as the empty text: no tokens, empty texts. Repeated rows are
    coded each; an empty table gives an empty result. ``keep`` names columns
    other than the three results.
    """
    src = Input(docs, text=text_col, **{f"k{i}": k for i, k in enumerate(keep)})
    fields = [
        T.StructField("n_tokens", T.LongType()),
        T.StructField("token_ids", T.BinaryType()),
        T.StructField("decoded", T.StringType()),
    ]
    inner = [src.name(f"k{i}") for i in range(len(keep))]
    coded = map_texts(src.df, src.name("text"), inner, fields, lambda: coder(tokenizer_path))
    return coded.toDF(*keep, "n_tokens", "token_ids", "decoded")


def op9_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    coded = encode_decode(
        documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("word_bpe_49k.json"), ["doc_id"]
    )
    return coded.select(
        "doc_id",
        "n_tokens",
        F.sha2("token_ids", 256).alias("ids_sha256"),
        F.sha2(F.col("decoded").cast("binary"), 256).alias("decoded_sha256"),
    )
