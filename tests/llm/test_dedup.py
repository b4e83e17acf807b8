import hashlib
import random
import re
from collections import Counter, defaultdict

import pytest
from llm_cases import ROWS, SF_SMALL, plain_components, plain_fingerprint

from vitrine.llm.components import components
from vitrine.llm.op1_simhash import links, near_dedup, op1_simhash
from vitrine.llm import op1_simhash as op1
from vitrine.llm import op8_exact_dedup as op8
from vitrine.llm.op7_mixing import mix_sources
from vitrine.llm.op8_exact_dedup import exact_dedup


def norm(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


@pytest.mark.parametrize("bucket_bytes", [64 << 20, 16])
def test_exact_dedup_of_odd_rows(odd_docs, bucket_bytes):
    got = exact_dedup(odd_docs, bucket_bytes=bucket_bytes)
    assert [c for c in got.columns if c.lower() == "kept"] == ["kept"] and "DOC_ID" in got.columns
    rows = got.select("keep_id", "group_size", "kept", "text_sha256", "n_chars").collect()
    assert len(rows) == len(ROWS)
    groups = defaultdict(list)
    for r in ROWS:
        groups[hashlib.sha256(norm(r[1]).encode()).hexdigest()].append(r[0])
    kept = defaultdict(int)
    for r in rows:
        ids = groups[r["text_sha256"]]
        assert r["group_size"] == len(ids)
        assert r["keep_id"] == min((i for i in ids if i is not None), default=None)
        kept[r["text_sha256"]] += r["kept"]
    assert set(kept.values()) == {1} and len(kept) == len(groups)


def test_exact_dedup_of_nothing(no_docs):
    assert exact_dedup(no_docs).count() == 0


def test_fingerprints_and_components_of_odd_rows(odd_docs):
    got = near_dedup(odd_docs, keep=["n_chars", "kept"]).collect()
    assert len(got) == len(ROWS)
    prints = sorted({plain_fingerprint(r[1]) for r in ROWS})
    root = plain_components(prints)
    ids = defaultdict(list)
    for r in ROWS:
        ids[root[prints.index(plain_fingerprint(r[1]))]].append(r[0])
    staying = defaultdict(int)
    for r in got:
        c = root[prints.index(int(r["fingerprint"], 16))]
        assert r["component_id"] == min((i for i in ids[c] if i is not None), default=None)
        staying[c] += r["stays"]
    assert set(staying.values()) == {1}


def test_near_dedup_of_nothing(no_docs):
    assert near_dedup(no_docs).count() == 0


def test_query_matches_brute_force(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").select("doc_id", "text").orderBy("doc_id").collect()
    prints = [plain_fingerprint(d["text"]) for d in docs]
    root = plain_components(prints)
    want = {(d["doc_id"], f"{p:016x}", docs[r]["doc_id"]) for d, p, r in zip(docs, prints, root)}
    assert {tuple(r)[:3] for r in op1_simhash(spark, SF_SMALL).collect()} == want


@pytest.mark.parametrize("bits", [1, 2])
@pytest.mark.parametrize("pair_block", [1, 4, 64])
def test_links_join_dense_groups_in_any_block_size(spark, bits, pair_block):
    rnd = random.Random(bits)
    prints = set()
    for _ in range(12):  # chains and balls of near values
        p = rnd.getrandbits(64)
        for _ in range(25):
            prints.add(p)
            for _ in range(rnd.choice([1, 1, 2, 3])):
                p ^= 1 << rnd.randrange(64)
    prints = sorted(prints | {0, 1, (1 << 64) - 1})
    root = plain_components(prints, bits)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    edges = links(spark.createDataFrame([(p,) for p in signed], "fp long"), bits, pair_block)
    found = {r["node"]: r["root"] for r in components(edges, "a", "b").collect()}
    got, want = defaultdict(set), defaultdict(set)
    for p, s, r in zip(prints, signed, root):
        got[found.get(s, s)].add(p)
        want[r].add(p)
    assert sorted(map(sorted, got.values())) == sorted(map(sorted, want.values()))


def test_components_of_a_long_path(spark):
    edges = spark.createDataFrame([(i, i + 1) for i in range(60)] + [(100, 101), (200, 200)], "a long, b long")
    found = {r["node"]: r["root"] for r in components(edges, "a", "b").collect()}
    assert found == {**{i: 0 for i in range(1, 61)}, 101: 100}


def test_directory_splits_until_a_bucket_fits_or_is_one_address(spark):
    rnd = random.Random(3)
    near = [(5 << 40) + i for i in range(40)]  # differ in the last bits only
    addresses = {a: rnd.randint(1, 30) for a in [*near, *(rnd.getrandbits(64) - (1 << 63) for _ in range(300))]}
    addresses[7] = 5000  # one address beyond any bucket
    slots, bits = op8.directory(spark.createDataFrame(list(addresses.items()), "address long, bytes long"), 100)
    rows = slots.collect()
    of_slot = {r["slot"]: (r["bucket"], r["depth"]) for r in rows}
    assert len(of_slot) == len(rows)
    held = defaultdict(list)
    for a in addresses:
        held[of_slot[(a % (1 << 64)) >> (64 - bits)]].append(a)
    for (bucket, depth), members in held.items():
        assert sum(addresses[a] for a in members) <= 100 or len(members) == 1
        assert len({(a % (1 << 64)) >> (64 - depth) if depth else 0 for a in members}) == 1
    assert max(len(m) for m in held.values()) > 1 and bits > 50


def test_the_result_comes_through_the_directory(odd_docs, monkeypatch):
    right = Counter((r[0], r["group_size"]) for r in exact_dedup(odd_docs, bucket_bytes=16).collect())
    made = op8.directory

    def wrong(addresses, bucket_bytes):
        slots, bits = made(addresses, bucket_bytes)
        return slots.orderBy("slot").limit(slots.count() // 2), bits  # half of the slots are lost

    monkeypatch.setattr(op8, "directory", wrong)
    assert Counter((r[0], r["group_size"]) for r in exact_dedup(odd_docs, bucket_bytes=16).collect()) != right


@pytest.mark.parametrize("limit", [0, 32 << 20])
def test_texts_move_only_for_repeated_addresses(spark, monkeypatch, limit):
    monkeypatch.setattr(op8, "BROADCAST_BYTES", limit)
    docs = spark.createDataFrame([(i, f"text {i if i % 10 else 0}") for i in range(200)], "doc_id long, text string")
    out = {r["doc_id"]: (r["keep_id"], r["group_size"], r["kept"]) for r in exact_dedup(docs).collect()}
    assert out == {i: (i, 1, True) if i % 10 else (0, 20, i == 0) for i in range(200)}


def join_kinds(df):
    return set(re.findall(r"(?:SortMerge|ShuffledHash|BroadcastHash)Join", df._jdf.queryExecution().executedPlan().toString()))


def test_texts_stay_where_they_are(spark, odd_docs):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", 64 << 10)
    try:
        for df in (exact_dedup(odd_docs), near_dedup(odd_docs), mix_sources(odd_docs)):
            assert join_kinds(df) == {"BroadcastHashJoin"}
            assert df.count() == odd_docs.count()
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def test_large_results_are_joined_not_broadcast(spark, odd_docs, monkeypatch):
    def rows(df):
        return sorted(map(str, df.collect()))

    for module, run in ((op8, exact_dedup), (op1, near_dedup)):
        want = rows(run(odd_docs))
        with monkeypatch.context() as m:
            m.setattr(module, "BROADCAST_BYTES", -1)
            assert rows(run(odd_docs)) == want
