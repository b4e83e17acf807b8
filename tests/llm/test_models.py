import numpy as np
import pytest
from llm_cases import ROWS, SF_ORACLE
from pyspark.sql import functions as F

from vitrine.llm import op2_language_id as lid
from vitrine.llm import op3_licenses as lic
from vitrine.llm import op10_quality as qual
from vitrine.llm.common import bounded_sample


def test_languages_held_out(spark):
    lang = {r["doc_id"]: r["lang"] for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    rows = lid.op2_language_id(spark, SF_ORACLE).collect()
    assert len(rows) == len(lang) and all(0 <= r["score"] <= 1 for r in rows)
    held = [r for r in rows if r["held_out"]]
    assert np.mean([r["lang_pred"] == lang[r["doc_id"]] for r in held]) >= 0.97


def test_bundle_is_the_sum_of_bound_letters():
    space = lid.Space(64, 3, 5)
    seq = [0, *map(ord, "abcab"), 0, ord("c"), 0]
    want = sum(
        space.letter(seq[i], 2).astype(int) * space.letter(seq[i + 1], 1) * space.letter(seq[i + 2], 0)
        for i in range(len(seq) - 2)
    )
    assert (space.bundle("ABcab -- 12 c!") == want).all()
    assert space.bundle("12 ,.") is None


def test_language_of_odd_rows(odd_docs, no_docs):
    rows = lid.language_id(odd_docs, learn=F.lit(True)).collect()
    assert len(rows) == len(ROWS)
    for r in rows:
        letters = any(c.isalpha() for c in r["text"] or "") if "text" in r.asDict() else None
        assert (r["lang_pred"] == "und") == (not letters) and 0 <= r["score"] <= 1
    assert {r["lang_pred"] for r in lid.language_id(odd_docs, learn=F.lit(False)).collect()} == {"und"}
    assert lid.language_id(no_docs, learn=F.lit(True)).count() == 0


def test_many_languages_are_refused(spark):
    docs = spark.createDataFrame([(i, "abc", f"l{i}") for i in range(9)], "doc_id long, text string, lang string")
    with pytest.raises(ValueError):
        lid.language_id(docs, learn=F.lit(True), max_languages=8)


def test_quality_held_out(spark):
    label = {r["doc_id"]: r["quality"] for r in spark.read.parquet(f"{SF_ORACLE}/labels.parquet").collect()}
    rows = qual.op10_quality(spark, SF_ORACLE).collect()
    assert all(0 <= r["score"] <= 1 and r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    held = [r for r in rows if r["held_out"] and r["doc_id"] in label]
    assert np.mean([r["predicted"] == label[r["doc_id"]] for r in held]) >= 0.95


def test_marginals_equal_enumeration():
    rng = np.random.default_rng(2)
    sizes = [1, 4, 2, 6]
    doc = np.repeat(np.arange(4), sizes)
    emit, trans = rng.normal(size=len(doc)), rng.normal(size=(2, 2))
    good, pairs = qual.forward_backward(emit, doc, trans)
    want, want_pairs, at = [], np.zeros((2, 2)), 0
    for n in sizes:
        total, ones, two = 0.0, np.zeros(n), np.zeros((2, 2))
        for code in range(2**n):
            y = [code >> k & 1 for k in range(n)]
            w = np.exp(sum(emit[at + k] * y[k] for k in range(n)) + sum(trans[a, b] for a, b in zip(y, y[1:])))
            total += w
            ones += w * np.array(y)
            for a, b in zip(y, y[1:]):
                two[a, b] += w
        want += list(ones / total)
        want_pairs += two / total
        at += n
    assert np.allclose(good, want) and np.allclose(pairs, want_pairs)


def test_line_features_do_not_depend_on_the_batch():
    texts = [r[1] or "" for r in ROWS]
    own, size, doc = qual.line_features(texts)
    for i, t in enumerate(texts):
        alone, alone_size, _ = qual.line_features([t])
        assert np.allclose(own[doc == i], alone) and np.allclose(size[doc == i], alone_size)


def test_quality_of_odd_rows(spark, odd_docs, no_docs):
    labels = spark.createDataFrame(
        [(1, 1), (2, 1), (3, 1), (9, 0), (10, 0), (11, 0), (11, 1), (12, None), (None, 1), (77, 0)], "doc_id long, quality int"
    )
    rows = qual.quality(odd_docs, labels, F.lit(True)).collect()
    assert len(rows) == len(ROWS) and all(0 <= r["score"] <= 1 for r in rows)
    blank = {r["score"] for r in rows if not (r["text"] or "").strip()}
    assert len(blank) == 1
    none = spark.createDataFrame([], "doc_id long, quality int")
    assert {r["score"] for r in qual.quality(odd_docs, none, F.lit(True)).collect()} == {0.5}
    assert qual.quality(no_docs, labels, F.lit(True)).count() == 0


@pytest.fixture(scope="module")
def classifier(spark):
    lines = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").select(F.explode(F.split("text", "\n")).alias("line"))
    return lic.train(spark, lines.orderBy(F.xxhash64("line"), "line").limit(1500))


def test_planted_licences_are_found(spark, monkeypatch, classifier, odd_docs, no_docs):
    monkeypatch.setattr(lic, "train", lambda *a, **k: classifier)
    marks = {"MIT License": "MIT", "Apache License": "Apache-2.0", "GNU General": "GPL-3.0", "CC BY-NC": "CC-BY-NC-4.0",
             "All rights reserved": "unknown"}
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF_ORACLE}/documents.parquet").collect()}
    for r in lic.op3_licenses(spark, SF_ORACLE).collect():
        want = sorted({f for line in docs[r["doc_id"]].split("\n") for m, f in marks.items() if m in line})
        assert r["families"] == ",".join(want), r
    made = spark.createDataFrame(
        [(1, "x\nThis project is licensed under the Apache License, Version 2.0.\n\nReleased under the MIT License."),
         (2, "Licensed under the license of the licence holder of another license"), (3, None), (4, "the use of all")],
        "doc_id long, text string",
    )
    got = {r["doc_id"]: [(x["paragraph"], x["family"]) for x in r["licenses"]] for r in lic.license_scan(made).collect()}
    assert got[1] == [(1, "Apache-2.0"), (3, "MIT")] and got[3] == [] and got[4] == []
    assert {f for _, f in got[2]} <= {"unknown"}
    assert lic.license_scan(odd_docs).count() == len(ROWS) and lic.license_scan(no_docs).count() == 0


def test_probabilities_equal_plain_softmax(spark, classifier):
    line = "This work is licensed under the GNU General Public License, version 3."
    df = spark.createDataFrame([(line,), ("nothing of note",)], "line string").select(
        lic.grams(lic.words(F.col("line"))).alias("g")
    )
    for r in df.select("g", classifier.probabilities(F.col("g")).alias("p")).collect():
        found = [classifier.weights[g] for g in r["g"] if g in classifier.weights]
        if not found:
            assert r["p"][classifier.classes.index("none")] == 1.0
            continue
        z = (np.array(classifier.bias) + np.sum(found, axis=0)) / classifier.temperature
        p = np.exp(z - z.max())
        assert np.allclose(r["p"], p / p.sum())


NAMED = {
    "MIT": ["MIT License", "The MIT License (MIT)", "License: MIT", "SPDX-License-Identifier: MIT"],
    "Apache-2.0": ["Apache License 2.0", "Licensed under Apache-2.0", "Apache License, Version 2.0"],
    "GPL-3.0": ["GPLv3", "License: GPL-3.0"],
    "GPL-2.0": ["GPLv2", "This program is licensed under the GNU General Public License, version 2."],
    "LGPL-3.0": ["SPDX-License-Identifier: LGPL-3.0-or-later"],
    "BSD-3-Clause": ["BSD 3-Clause License"],
    "MPL-2.0": ["Mozilla Public License 2.0"],
    "CC-BY-4.0": ["Licensed under CC BY 4.0."],
    "CC-BY-SA-4.0": ["CC BY-SA 4.0"],
    "CC-BY-NC-4.0": ["Licensed under CC BY-NC 4.0."],
}
NEAR = [
    "Licensed under the Apache License, Version 1.1.", "Licensed under the BSD 2-Clause License.", "Licensed under CC BY-ND 4.0.",
    "CC BY-NC-SA 4.0", "Licensed under CC BY-SA 3.0.", "SPDX-License-Identifier: MIT-0", "SPDX-License-Identifier: BSD-3-Clause-Clear",
    "Licensed under the GNU Lesser General Public License, version 2.1.", "Released under the Apache License.",
    "This work is licensed under a Creative Commons Attribution-NoDerivatives 4.0 International License.",
]


def test_a_family_is_told_from_its_neighbours(spark, monkeypatch, classifier):
    monkeypatch.setattr(lic, "train", lambda *a, **k: classifier)
    lines = [(line, f) for f, named in NAMED.items() for line in named] + [(line, "unknown") for line in NEAR]
    docs = spark.createDataFrame([(i, f"one\n{line}") for i, (line, _) in enumerate(lines)], "doc_id long, text string")
    got = {r["doc_id"]: [(x["paragraph"], x["family"]) for x in r["licenses"]] for r in lic.license_scan(docs).collect()}
    assert {line: got[i] for i, (line, _) in enumerate(lines)} == {line: [(1, f)] for line, f in lines}


def test_a_frequent_notice_of_no_listed_family_is_found(spark):
    notices = ["All rights reserved.", "Released under the Acme Community License."]
    some = spark.read.parquet(f"{SF_ORACLE}/documents.parquet").orderBy("doc_id").limit(360).select("doc_id", "text").collect()
    rows = [(i, f"{r['text'] or ''}\n{notices[i % 2] if i % 3 == 0 else 'nothing of note'}") for i, r in enumerate(some)]
    for r in lic.license_scan(spark.createDataFrame(rows, "doc_id long, text string")).collect():
        last = [x["family"] for x in r["licenses"] if x["paragraph"] == r["text"].count("\n")]
        assert last == (["unknown"] if r["doc_id"] % 3 == 0 else []), r["doc_id"]


def test_calibration_lines_are_not_trained_on(spark):
    lines = spark.createDataFrame([(f"plain words {i}",) for i in range(40)], "line string")
    rows = lic.examples(spark, lines).collect()
    learned, held = ({(r["label"], r["line"]) for r in rows if r["held"] == h} for h in (False, True))
    assert not {line for _, line in learned} & {line for _, line in held}
    assert {f for f, _ in held} == {f for f, _ in learned} == {"none", "unknown", *lic.NOTICES}
    made = {line for f, line in held if f != "none"}
    assert not made & {f"{lead} {n}".strip() for lead in lic.LEADS for f in lic.NOTICES for n in lic.NOTICES[f] + lic.TITLES[f]}


def test_sample_of_repeated_rows_is_full(spark):
    docs = spark.range(20_000).select(F.concat(F.lit("text "), F.col("id") % 50).alias("text"))
    got = [r["text"] for r in bounded_sample(docs, "text", 30).collect()]
    assert len(got) == len(set(got)) == 30


def test_repeated_ids_do_not_push_documents_out_of_the_sample(spark):
    docs = spark.createDataFrame([(i, f"text {i}") for i in range(8)] + [(0, f"copy {i}") for i in range(40)], "id long, text string")
    labels = spark.createDataFrame([(i, int(i > 3)) for i in range(8)], "id long, label int")
    rows = qual.sample_features(docs, labels, 8, 200)
    assert sorted(y for _, _, y in rows) == [0] * 4 + [1] * 4


def test_the_plan_does_not_grow_with_the_notices(spark):
    for made in (lic.like_a_notice(F.col("t")), lic.confirmed(F.col("t"), "MIT")):
        assert str(made).count("array_intersect") == 1
    lines = [*lic.NOTICES["MIT"], *lic.TITLES["MIT"], "Permission is granted", "MIT", "", "of this software and associated"]
    df = spark.createDataFrame([(x,) for x in lines], "line string").withColumn("t", lic.words(F.col("line")))
    for r in df.select("line", lic._shares(lic._held_pairs(F.col("t")), lic.NOTICES["MIT"], 0.6).alias("got")).collect():
        t = lic._words(r["line"])
        held = {" ".join(t[i : i + 2]) for i in range(max(1, len(t) - 1))} if t else set()
        both = [(len(held & set(lic._pairs(n))), len(lic._pairs(n))) for n in lic.NOTICES["MIT"]]
        assert r["got"] == any(k >= 0.6 * n or (k >= 3 and k >= 0.6 * len(held)) for k, n in both), r
