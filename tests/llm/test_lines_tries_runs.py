"""Line dedup, the conversation prefix trie and periodic runs against plain versions."""

import hashlib
import random
import re
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pytest
from llm_cases import LONG, ROWS, SF_ORACLE, SF_SMALL
from pyspark.sql import functions as F

from vitrine.llm import op11_line_dedup as lines_op
from vitrine.llm import op12_prefix_trie as trie_op
from vitrine.llm import op13_periodic_runs as runs_op

BLANK = "\x20\x09\x0a\x0b\x0c\x0d"


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


# ------------------------------------------------------------ line dedup


def plain_line_dedup(texts, min_docs, min_chars=1):
    def key(line):
        return re.sub("[A-Z]", lambda m: m[0].lower(), line).strip(BLANK)

    split = [(t or "").split("\n") for t in texts]
    found = Counter(k for lines in split for k in {key(x) for x in lines} if len(k) >= min_chars)
    kept = [[x for x in lines if found[key(x)] < min_docs] for lines in split]
    return [(len(a), len(a) - len(b), "\n".join(b)) for a, b in zip(split, kept)]


LINE_TEXTS = [
    "Same\nother\n\n  same  ", " SAME\n", None, "", "\n\n\n", "tail\nSame\r\ntail\n", "É\né\nSame", " Same",
    "same\n" * 2000 + "x", "a\nb\nc", "a\nb\nd", "a\nb\ne", "é\nÉ", *[f"line {i % 7}\nonly {i}\n Same" for i in range(60)],
]


@pytest.mark.parametrize("min_docs, min_chars, batches", [(2, 1, 6), (3, 2, 5), (10, 1, 1), (61, 0, 2)])
def test_line_dedup_equals_a_plain_version(spark, min_docs, min_chars, batches):
    docs = spark.createDataFrame(list(enumerate(LINE_TEXTS)), "doc_id long, text string")
    out = lines_op.line_dedup(docs, min_docs=min_docs, min_chars=min_chars, batches=batches)
    got = {r["doc_id"]: (r["n_lines"], r["n_dropped"], r["kept_text"]) for r in out.collect()}
    assert [got[i] for i in range(len(LINE_TEXTS))] == plain_line_dedup(LINE_TEXTS, min_docs, min_chars)


def test_line_dedup_on_odd_rows(spark, odd_docs, no_docs):
    out = lines_op.line_dedup(odd_docs, min_docs=2)
    assert out.columns == odd_docs.columns + ["n_lines", "n_dropped", "kept_text"]
    got = Counter((r[0], r[1], r["n_lines"], r["n_dropped"], r["kept_text"]) for r in out.collect())
    assert got == Counter((r[0], r[1], *p) for r, p in zip(ROWS, plain_line_dedup([r[1] for r in ROWS], 2)))
    assert lines_op.line_dedup(no_docs).collect() == []
    assert not [t.name for t in spark.catalog.listTables() if t.name.startswith("line_run_")]


def test_line_runs_levels_settled_and_heavy(spark):
    def batch(names):
        return spark.createDataFrame([(n.encode(),) for n in names], "mark binary")

    runs = lines_op.LineRuns(spark, threshold=3)
    total = Counter()
    for b in range(5):
        names = ["hot"] * 4 + [f"m{b}", f"m{b % 2}", "late"]
        total.update(names)
        runs.add(batch(names), 10**9 if b % 2 else len(names))  # a huge batch: no mark of it is heavy
    assert [len(level) for level in runs.levels] == [1, 0, 1]
    got = {r["mark"].decode(): r["n"] for r in runs.merged().collect()}
    assert got["hot"] == 12  # counted by the heavy batches 0, 2 and 4; settled in 1 and 3
    assert {m for m, n in got.items() if n >= 3} == {m for m, n in total.items() if n >= 3}
    assert all(got[m] == total[m] for m in got if total[m] < 3)
    runs.drop()
    assert runs.levels == [] and runs.merged().count() == 0


@pytest.mark.parametrize("module, table, query", [
    (lines_op, "documents", lines_op.op11_line_dedup), (trie_op, "conversations", trie_op.op12_prefix_trie),
])
def test_queries_equal_their_sql(spark, module, table, query):
    con = duckdb.connect()
    con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_ORACLE}/{table}.parquet'")
    got, want = query(spark, SF_ORACLE), con.sql(module.SQL)
    assert got.columns == want.columns
    rows = Counter(map(tuple, got.collect()))
    assert rows == Counter(want.fetchall()) and rows


# ------------------------------------------------------- conversation trie


def plain_trie(rows, rebuild):
    """Nodes of (conv_id, turn, role, text) rows as tuples in the operator's column order."""
    own = defaultdict(list)
    for c, turn, role, text in rows:
        if c is not None:
            tid = hashlib.sha256(f"{len((role or '').encode())}:{role or ''}{text or ''}".encode()).hexdigest()[:32]
            own[c].append(((turn is not None, turn or 0), role or "", tid, text or ""))
    seq = {c: [(t[1], t[3]) for t in sorted(turns)] for c, turns in own.items()}
    if rebuild:
        made = {}
        for c, turns in seq.items():
            h = zlib.crc32(str(c).encode()) % 9
            made[c] = seq.get(c - int(np.fmod(c, 5)), [])[:h] + turns[h:]
        seq = made
    members, ending, kids = defaultdict(list), defaultdict(list), defaultdict(set)
    for c, turns in seq.items():
        ending[tuple(turns)].append(c)
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
            if d:
                kids[tuple(turns[: d - 1])].add(tuple(turns[:d]))
    out = Counter()
    for k, m in members.items():
        sub = [x for x in members if x[: len(k)] == k]
        saved = sum((len(members[x]) - 1) * len(x[-1][1].encode()) for x in sub if x)
        parent = min(members[k[:-1]]) if k else None
        listed = ",".join(map(str, sorted(ending[k])))
        out[(min(m), len(k), parent, len(m), len(kids[k]), sum(not kids[x] for x in sub), saved, sha(listed))] += 1
    return out


TURNS = [
    *[(c, t, "user", f"first {c % 3}" if t == 0 else f"turn {c} {t}") for c in range(23) for t in range(c % 4 + 1)],
    *[(c, t, "user", f"hot {t}") for c in range(100, 140) for t in range(5)],
    (-3, 0, "user", "minus"), (-5, 1, "user", "base"), (-5, 0, None, None), (41, None, "a", "nul"), (41, 0, "a", "z"),
    (41, 0, "a", "y"), (41, 0, "a", "y"), (41, 0, None, "y"), (None, 0, "a", "lost"), (None, None, None, None),
    (42, 0, "us", "er"), (43, 0, "u", "ser"), (44, 0, "", ""), (45, 0, "user", LONG), (46, 0, "user", LONG),
    (2**62, 0, "é", "日本"), *[(51, t, "x", "deep") for t in range(300)], *[(52, t, "x", "deep") for t in range(290)],
]


@pytest.mark.parametrize("rebuild", [False, True])
def test_trie_equals_a_plain_version(spark, rebuild):
    rows = [(*r, "n", "p", "x") for r in TURNS]
    names = "conv_id long, turn long, role string, text string, node string, part string, KEY string"
    out = trie_op.prefix_trie(spark.createDataFrame(rows, names), rebuild=rebuild).drop("node", "parent")
    assert Counter(map(tuple, out.collect())) == plain_trie(TURNS, rebuild)


def test_trie_of_no_conversations(spark):
    none = spark.createDataFrame([], "conv_id long, turn long, role string, text string")
    assert trie_op.prefix_trie(none).collect() == []
    lost = spark.createDataFrame([(None, 0, "a", "b")], none.schema)
    assert trie_op.prefix_trie(lost, rebuild=True).collect() == []


@pytest.mark.parametrize("seed", range(12))
def test_parts_and_blocks_add_up(seed, monkeypatch):
    """Any cut of the sorted keys into parts and blocks gives the sums of one tree over all keys."""
    rng = random.Random(seed)
    ids = [bytes(rng.choice([0, 1, 2, 255]) for _ in range(16)) + rng.randrange(99).to_bytes(4) for _ in range(rng.choice([2, 6, 40]))]
    keys = sorted({b"".join(rng.choice(ids) for _ in range(rng.randint(0, 5))) for _ in range(120)})
    rows = [(k, rng.randint(1, 4), rng.randrange(10**6)) for k in keys]

    def added(parts):
        sums = {}
        for node, parent, depth, least, *rest in parts:
            was = sums.setdefault((node, parent, depth), [least, [0] * 4])
            was[0] = min(was[0], least)
            was[1] = [a + b for a, b in zip(was[1], rest)]
        return sums

    whole = added(trie_op.turn_nodes(rows, -1, False))
    prefixes = {k[: d * 20] for k in keys for d in range(len(k) // 20 + 1)}
    assert len(whole) == len(prefixes)
    for p in prefixes:
        below = [x for x in prefixes if x.startswith(p)]
        n = {x: sum(r[1] for r in rows if r[0].startswith(x)) for x in below}
        least, (count, children, leaves, saved) = next(v for k, v in whole.items() if k[0] == hashlib.sha256(p).digest()[:16])
        assert least == min(r[2] for r in rows if r[0].startswith(p)) and count == n[p]
        assert children == sum(len(x) == len(p) + 20 for x in below)
        assert leaves == sum(not any(y != x and y.startswith(x) for y in below) for x in below)
        assert saved == sum((n[x] - 1) * int.from_bytes(x[-4:]) for x in below if x)
    monkeypatch.setattr(trie_op, "BLOCK_KEYS", rng.choice([1, 2, 7]))
    cuts = sorted(rng.sample(range(1, len(rows)), min(4, len(rows) - 1)))
    parts = [rows[a:b] for a, b in zip([0, *cuts], [*cuts, len(rows)])]
    near = {p: x for p, *x in trie_op.borders((i, part[0][0], part[-1][0]) for i, part in enumerate(parts))}
    stream = [(i, *row, *near[i]) for i, part in enumerate(parts) for row in part]
    assert added(trie_op.blocks(stream)) == whole


def test_node_layouts_grow():
    for count, kind in ((4, 4), (5, 16), (16, 16), (17, 48), (48, 48), (49, 256), (256, 256)):
        root, order = trie_op.Node(b""), list(range(256))
        random.Random(count).shuffle(order)
        for b in order[:count]:
            trie_op.insert(root, bytes([b, 1, 2]), 1, b)
            trie_op.insert(root, bytes([b, 1, 2]), 1, b + 1)
        assert root.kind == kind
        assert [k.path[0] for k in root.children()] == sorted(order[:count])
        assert all(root.child(b).least == b and root.child(b).n == 2 for b in order[:count])
        assert all(root.child(b) is None for b in order[count:])


# ------------------------------------------------------------ periodic runs


def plain_runs(w):
    n, out = len(w), []
    for q in range(1, n // 4 + 1):
        i = 0
        while i + q < n:
            if w[i] != w[i + q]:
                i += 1
                continue
            j = i
            while j + q < n and w[j] == w[j + q]:
                j += 1
            size = j + q - i
            if size >= max(6, 4 * q) and not any(all(w[x] == w[x + d] for x in range(i, i + size - d)) for d in range(1, q)):
                out.append((i, size, q))
            i = j + 1
    return sorted(out, key=lambda r: (r[0], r[2]))


def plain_row(doc_id, text, plant):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text or "") if w]
    n, h = len(words), zlib.crc32(("" if doc_id is None else str(doc_id)).encode())
    if plant and h % 10 == 0 and n:
        g = h // 10
        a = g % n
        p = 1 + (n - a) // (3 + g % 8)
        words = [words[i] if i < a else words[a + (i - a) % p] for i in range(n)]
    runs = plain_runs(words)
    best = min(runs, key=lambda r: (-r[1] / r[2], r[0], r[2]), default=None)
    top = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
    gone = {i for s, size, q in runs for i in range(s + q, s + size)}
    kept = " ".join(w for i, w in enumerate(words) if i not in gone)
    return (doc_id, len(runs), *top, sha("".join(f"{a},{b},{c}\n" for a, b, c in runs)), sha(kept)), runs, kept


@pytest.mark.parametrize("chunk", [1, 2, 5, 64, 1 << 18])
def test_runs_equal_a_plain_version(chunk, monkeypatch):
    monkeypatch.setattr(runs_op, "CHUNK", chunk)
    rng, some = random.Random(chunk), 0
    for _ in range(150):
        texts = []
        for _ in range(rng.randint(0, 5)):
            n = rng.choice([0, 1, 5, 6, 8, 30, 120])
            w = [rng.randint(0, rng.choice([0, 1, 2, 9])) for _ in range(n)]
            for _ in range(rng.randint(0, 3) if n else 0):
                a = rng.randrange(n)
                p = 1 + rng.randrange(max(1, n // 4))
                for i in range(a, min(n, a + p * rng.randint(2, 9) + rng.randint(0, p))):
                    w[i] = w[a + (i - a) % p]
            texts.append(w)
        got = runs_op.runs_of([np.array(t, np.int64) for t in texts])
        assert got == [plain_runs(t) for t in texts]
        some += sum(map(len, got))
    assert some > 50


def test_a_long_text_of_one_word_is_one_run():
    many = np.zeros(300_000, np.int64)
    assert runs_op.runs_of([many, np.arange(9)]) == [[(0, 300_000, 1)], []]


def test_runs_on_odd_rows(spark, odd_docs, no_docs):
    out = runs_op.periodic_runs(odd_docs)
    assert out.columns[: len(odd_docs.columns)] == odd_docs.columns
    rows = out.collect()
    names = ("n_runs", "start", "length", "period", "exponent_milli", "runs_sha256", "collapsed_sha256")
    got = Counter((r[0], *(r[n] for n in names)) for r in rows if len(r[1] or "") < 100)
    assert got == Counter(plain_row(r[0], r[1], False)[0] for r in ROWS if len(r[1] or "") < 100)
    long = [r for r in rows if r[0] == 7]
    assert len(long) == 2 and all(r["runs"] == [[0, 90_000, 3]] and r["collapsed"] == "word another third end" for r in long)
    assert runs_op.periodic_runs(no_docs).collect() == []


def test_runs_query_equals_a_plain_version(spark):
    docs = spark.read.parquet(f"{SF_SMALL}/documents.parquet").where(F.length("text") < 20_000).select("doc_id", "text").collect()
    got = {r["doc_id"]: tuple(r) for r in runs_op.op13_periodic_runs(spark, SF_SMALL).collect()}
    want = {r["doc_id"]: plain_row(*r, True)[0] for r in docs}
    assert {d: got[d] for d in want} == want
    assert sum(w[1] for w in want.values()) > 5
