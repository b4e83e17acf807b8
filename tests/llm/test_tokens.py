import hashlib
import random

import numpy as np
import public_tokenizers
import pyarrow as pa
from tokenizers import Tokenizer
from llm_cases import ROWS, SF_SMALL

from vitrine.llm.op5_token_counts import counter, segments, token_counts
from vitrine.llm.op9_bpe import Bpe, coder, encode_decode, op9_bpe


BYTES = public_tokenizers.path("byte_bpe_50k.json")
WORDS = public_tokenizers.path("word_bpe_49k.json")


def odd_texts() -> list[str]:
    rnd = random.Random(3)
    chars = [chr(i) for i in range(0x250)] + list("ΣσςİȾ日本 　😀नि١́ ")
    vocab = [t.replace("</w>", "") for t in Tokenizer.from_file(WORDS).get_vocab()]
    out = ["".join(rnd.choice(chars) for _ in range(rnd.randrange(30))) for _ in range(800)]
    out += ["".join(rnd.choice("etaoinshrdlu '0") for _ in range(rnd.randrange(120))) for _ in range(400)]
    out += ["".join(rnd.choice(vocab) for _ in range(rnd.randint(1, 5))) for _ in range(1500)]
    return out + ["", "=" * 3000, "ab" * 3000, "a<|endoftext|>b <|startoftext|>", "<|ENDOFTEXT|>", "\x00 \x01\x02"]


def test_coding_equals_the_library():
    lib, texts = Tokenizer.from_file(WORDS), odd_texts()
    n, ids, decoded = coder(WORDS)(pa.array(texts))
    for t, e, k, i, d in zip(texts, lib.encode_batch(texts, add_special_tokens=False), n, ids, decoded):
        assert np.frombuffer(i, "<u4").tolist() == e.ids and k == len(e.ids), t
        assert d == lib.decode(e.ids, skip_special_tokens=False), t


def test_speculation_is_checked_not_trusted():
    bpe = Bpe(WORDS)
    words = ["".join(map(bpe.letters.__getitem__, w.encode())) for w in ("thereupon", "unbelievable", "ththth", "a")]
    assert bpe.encode_words(words) == [bpe.merge(bpe.symbols(w)) for w in words]
    assert bpe._merge_long(bpe.symbols("abcabcabc")) == bpe._merge_short(bpe.symbols("abcabcabc"))


def test_coding_of_odd_rows(spark, odd_docs, no_docs):
    lib = Tokenizer.from_file(WORDS)
    got = encode_decode(odd_docs, WORDS, ["kept", "n_chars"]).collect()
    want = sorted(lib.encode(r[1] or "", add_special_tokens=False).ids for r in ROWS)
    assert sorted(np.frombuffer(r["token_ids"], "<u4").tolist() for r in got) == want
    assert encode_decode(no_docs, WORDS, ["kept"]).count() == 0


def test_coding_query(spark):
    lib = Tokenizer.from_file(WORDS)
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()}
    for r in op9_bpe(spark, SF_SMALL).collect():
        ids = lib.encode(docs[r["doc_id"]] or "", add_special_tokens=False).ids
        assert r["n_tokens"] == len(ids)
        assert r["ids_sha256"] == hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        decoded = lib.decode(ids, skip_special_tokens=False)
        assert r["decoded_sha256"] == hashlib.sha256(decoded.encode()).hexdigest()


def test_counts_of_segments_add_up():
    lib = Tokenizer.from_file(BYTES)
    texts = odd_texts() + [" ".join(odd_texts()), "\n".join(odd_texts()), " a  b\t c" * 20_000, "x" * 90_000, None]
    want = [len(lib.encode(t or "", add_special_tokens=False).ids) for t in texts]
    assert counter(BYTES)(pa.array(texts))[0] == want
    assert len(segments(" a  b\t c" * 20_000)) > 1


def test_counts_of_odd_rows(odd_docs, no_docs):
    lib = Tokenizer.from_file(BYTES)
    got = sorted((r["n_bytes"], r["n_tokens"], r["over_limit"]) for r in token_counts(odd_docs, BYTES).collect())
    n = [(len((r[1] or "").encode()), len(lib.encode(r[1] or "", add_special_tokens=False).ids)) for r in ROWS]
    assert got == sorted((b, t, t > 512) for b, t in n)
    assert token_counts(no_docs, BYTES).count() == 0


def test_frequent_words_outlive_a_full_cache(monkeypatch):
    from vitrine.llm import op9_bpe

    monkeypatch.setattr(op9_bpe, "CACHE_WORDS", 40)
    bpe, lib = Bpe(WORDS), Tokenizer.from_file(WORDS)
    for k in range(12):
        text = f"often seen {' '.join('w' + chr(97 + k) + chr(97 + i) for i in range(15))}"
        got = bpe.lookup([words := bpe.split(text)])
        ids = b"".join(got[w][0] for w in words)
        assert np.frombuffer(ids, "<u4").tolist() == lib.encode(text, add_special_tokens=False).ids
        assert len(bpe.cache) + len(bpe.older) <= 40
    assert bpe.seen == 2 + 12 * 15  # no word was coded twice
