"""Token counts: Arrow batches in, lengths out.

Every task encodes its texts with the tokenizers library and returns only the
number of tokens. Texts longer than ``SEGMENT`` characters are cut where the
byte-level pre-tokenizer always ends a token: before a single space between two
characters that are not white space. There the token on the left cannot reach
over the space and the one on the right begins with it, so counts of segments
add up exactly. Segments are packed into library calls of about equal bytes, so
a long text neither makes a call of its own size nor waits behind short ones.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.llm.common import Input, documents, map_texts

SEGMENT = 32_768  # characters of a long text per segment
BATCH = 262_144  # bytes of UTF-8 per call of the library
#: Python's \s holds every Unicode white space (and a few controls more), so both neighbours are sure not to be one.
SAFE = re.compile(r"(?<=\S) (?=\S)")


def segments(text: str) -> list[str]:
    """The text cut at safe places only; without any, a text stays whole."""
    out, start = [], 0
    while len(text) - start > SEGMENT:
        m = SAFE.search(text, start + SEGMENT)
        if not m:
            break
        out.append(text[start : m.start()])
        start = m.start()
    out.append(text[start:])
    return out


def counter(path: str):
    """Function from an Arrow string array to the token count of each text."""
    import os

    os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one core per task
    from tokenizers import Tokenizer

    tok = Tokenizer.from_file(path)
    tok.no_truncation()
    tok.no_padding()

    def lengths(texts: list[str]) -> list[int]:
        return [len(e.ids) for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    def count(column) -> list:
        totals = [0] * len(column)
        call, owner, size = [], [], 0

        def flush():
            for i, n in zip(owner, lengths(call)):
                totals[i] += n
            call.clear()
            owner.clear()

        for i, text in enumerate(column.to_pylist()):
            for s in segments(text) if text else ():
                call.append(s)
                owner.append(i)
                size += len(s.encode())
                if size >= BATCH:
                    flush()
                    size = 0
        flush()
        return [totals]

    return count


def token_counts(
    docs: DataFrame, tokenizer_path: str, limit: int = 512, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """id, n_bytes (UTF-8), n_tokens and over_limit (more than ``limit`` tokens) of every row.

    Whole texts, no special tokens added; special strings inside a text count as
    the library counts them by default. Null counts as the empty text (0 bytes,
    0 tokens). Repeated rows are counted each; an empty table gives an empty
    result.
    """
    src = Input(docs, id=id_col, text=text_col)
    sized = src.df.select(
        src["id"].alias("id"),
        F.coalesce(F.octet_length(src["text"]), F.lit(0)).cast("long").alias("n_bytes"),
        src["text"].alias("text"),
    )
    counted = map_texts(
        sized, "text", ["id", "n_bytes"], [T.StructField("n_tokens", T.LongType())], lambda: counter(tokenizer_path)
    )
    return counted.select(
        F.col("id").alias(id_col), "n_bytes", "n_tokens", (F.col("n_tokens") > limit).alias("over_limit")
    )


def op5_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return token_counts(documents(spark, sf_dir, "doc_id", "text"), public_tokenizers.path("byte_bpe_50k.json"))
