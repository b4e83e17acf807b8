import hashlib
import re
from collections import Counter, defaultdict

import corpus_pipeline
import duckdb
import numpy as np
import public_tokenizers
from llm_cases import ROWS, SF_SMALL, plain_components, plain_fingerprint
from tokenizers import Tokenizer

from vitrine.llm import op7_mixing
from vitrine.llm.op10_quality import op10_quality
from vitrine.llm.queries import ORACLE, QUERIES


def test_run_equals_a_plain_version(spark):
    good = {r["doc_id"] for r in op10_quality(spark, SF_SMALL).collect() if r["predicted"]}
    docs = sorted(map(tuple, spark.read.parquet(f"{SF_SMALL}/documents.parquet").collect()))
    docs = [d for d in docs if d[0] in good]
    assert 0 < len(docs) < spark.read.parquet(f"{SF_SMALL}/documents.parquet").count()
    first = {}
    for d in docs:
        first.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", d[1] or ""), d)
    docs = sorted(first.values())
    root = plain_components([plain_fingerprint(d[1]) for d in docs])
    docs = [d for i, d in enumerate(docs) if root[i] == i]
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR, lang VARCHAR, source VARCHAR, n_chars BIGINT)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?, ?, ?)", docs)
    copies = {r[0]: int(r[4] / r[1] + 0.5) if r[1] else 0 for r in con.sql(op7_mixing.SQL).fetchall()}
    lib = Tokenizer.from_file(public_tokenizers.path("word_bpe_49k.json"))
    want = Counter()
    for d in docs:
        ids = lib.encode(d[1], add_special_tokens=False).ids
        digest = hashlib.sha256(np.array(ids, "<u4").tobytes()).hexdigest()
        want[(d[0], d[2], d[3], len(ids), digest)] += copies[d[0]]
    rows = corpus_pipeline.run(spark, SF_SMALL).collect()
    got = Counter((r["doc_id"], r["lang"], r["source"], r["n_tokens"], r["ids_sha256"]) for r in rows)
    assert got == +want


def test_stages_keep_the_columns_of_documents(spark, odd_docs):
    for name, stage in corpus_pipeline.STAGES[1:-1]:
        out = stage(spark, odd_docs, SF_SMALL)
        assert out.columns == odd_docs.columns
        kept = out.toDF(*[f"c{i}" for i in range(len(out.columns))]).collect()
        assert 0 < len(kept) and {r["c7"] for r in kept} == {"k"}, name
        groups = defaultdict(int)
        for r in kept:
            groups[re.sub(r"[\x20\x09-\x0D]+", " ", r["c1"] or "")] += 1
        if name == "exact_dedup":
            assert set(groups.values()) == {1}
            assert len(groups) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r[1] or "") for r in ROWS})


def test_registered_queries():
    assert set(ORACLE) <= set(QUERIES)
    assert sorted(int(re.match(r"op(\d+)_", n)[1]) for n in QUERIES if n.startswith("op")) == list(range(1, 14))
