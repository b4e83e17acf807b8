"""Record scans: quoted line ends over byte ranges, and records kept as they were read."""

import os
import random
import tempfile
from collections import Counter

import pytest
from pyspark.sql import functions as F

from vitrine.plans.warehouse import Warehouse
from vitrine.sources import ingest as I
from vitrine.sources import records as R
from vitrine.sources.feeds import FEEDS

HEAD = "review_id,order_id,review_score,review_comment_title,review_comment_message,review_creation_date,review_answer_timestamp"


def _file(text, name="f.csv"):
    path = os.path.join(tempfile.mkdtemp(prefix="records-"), name)
    with open(path, "w", newline="") as f:
        f.write(text)
    return path


@pytest.fixture()
def small_ranges(spark):
    before = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    spark.conf.set("spark.sql.files.maxPartitionBytes", "1500")
    spark.conf.set("spark.sql.files.openCostInBytes", "0")
    yield
    for k, v in before.items():
        spark.conf.set(k, v)


def _plain_records(text):
    """Records by walking the characters; the lines of an open one apart."""
    records, held, inside = [], "", False
    for ch in text:
        if ch == '"':
            inside = not inside
        if ch == "\n" and not inside:
            records.append(held)
            held = ""
        else:
            held += ch
    lines = held.split("\n") if inside else []
    if inside and lines and lines[-1] == "":
        lines.pop()  # the file's last line end
    if held and not inside:
        records.append(held)
    strip = lambda x: x[:-1] if x.endswith("\r") else x
    return [strip(r) for r in records[1:] if strip(r)], [strip(x) for x in lines]


@pytest.mark.parametrize("seed", range(6))
def test_quoted_records_equal_a_walk_over_the_characters(spark, small_ranges, seed):
    rng, rows = random.Random(seed), [HEAD]
    for i in range(400):
        message = "".join(rng.choice(["x" * 9, '""', ",", "\n", "\r\n", " é"]) for _ in range(rng.choice([0, 3, 12])))
        if rng.random() < 0.02:
            message += "long line\n" * 300  # longer than a range
        rows.append(f'r{i},o{i},5,,"{message}",,' if message or rng.random() < 0.5 else f"r{i},o{i},5,,,,")
    text = "\n".join(rows) + "\n"
    if seed % 3 == 0:
        text += 'r9,"open\nlost "" line\nmore,"",x\n'
    path = _file(text)
    got = R.quoted_records(spark, path).collect()
    records, unpaired = _plain_records(text)
    assert Counter(r.record for r in got if not r.open) == Counter(records)
    assert Counter(r.record for r in got if r.open) == Counter(unpaired)
    scan = R._physical(spark, path)
    assert scan.rdd.getNumPartitions() > 3 and scan.select("block").distinct().count() > 3  # one file, many tasks


def test_several_files_and_a_file_of_a_header_only(spark, small_ranges):
    folder = tempfile.mkdtemp(prefix="records-")
    for name, text in {"a.csv": HEAD + "\n", "b.csv": HEAD + '\nr1,"a\nb",1\n', "c.csv": "", "d.csv": HEAD + "\nr2,,2"}.items():
        with open(os.path.join(folder, name), "w") as f:
            f.write(text)
    got = {(r.record, r.etl_source_file) for r in R.quoted_records(spark, folder).collect()}
    assert got == {('r1,"a\nb",1', "b.csv"), ("r2,,2", "d.csv")}
    assert {r.record for r in R.lines(spark, f"{folder}/d.csv").collect()} == {"r2,,2"}


def test_well_formed_and_field_counts(spark):
    cases = {
        "a,b": (True, 2), "": (True, 1), ",,": (True, 3), '"a,b",c': (True, 2), '"a""b"': (True, 1), '"a\n,b",': (True, 2),
        'a"b"': (False, None), '"a"b,c': (False, None), '"open,b': (False, None), '"a"",b': (False, None), '""': (True, 1),
        '"' + 'x""' * 30_000 + '",y': (True, 2),
    }
    df = spark.createDataFrame([(k,) for k in cases], "r string")
    for row in df.select("r", R.well_formed(F.col("r")), R.n_fields(F.col("r"))).collect():
        ok, n = cases[row[0]]
        assert row[1] is ok and (not ok or row[2] == n), row[0][:40]


def test_rejects_are_kept_byte_for_byte(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    bad = ['s1,01001,city,SP,more,"and, more"', 's2,01001,"open', 's3,01001,ci"t"y,SP', "s" * 51 + ",01001,c,SP"]
    good = ["s4,01001,city,SP", "s5", 's6,01001,"a ""b"", c",SP\r']
    path = _file("\n".join(["seller_id,seller_zip_code_prefix,seller_city,seller_state", *bad, "", *good]))
    loaded, rejected = I.ingest_feed(wh, FEEDS["sellers"], path, 1, "2024-01-01 00:00:00", long_rows="reject")
    assert (loaded, rejected) == (3, 4)
    assert Counter(r.raw_data for r in wh.read("stg_rejected_records").collect()) == Counter(bad)
    cities = {r.seller_id: r.seller_city for r in spark.read.parquet(wh.path("stg_sellers")).collect()}
    assert cities == {"s4": "city", "s5": None, "s6": 'a "b", c'}
    with pytest.raises(ValueError):
        I.ingest_feed(wh, FEEDS["sellers"], path, 2, "2024-01-01 00:00:00", long_rows="drop")


def test_an_open_quote_in_reviews_rejects_its_lines(spark, tmp_root):
    wh = Warehouse(spark, tmp_root)
    path = _file(HEAD + '\nr1,o1,5,,"two\nlines",,\nr2,o2,4,,"never closed,,\nr3,o3,1,,,,\n')
    assert I.ingest_feed(wh, FEEDS["order_reviews"], path, 1, "2024-01-01 00:00:00") == (1, 2)
    assert {r.raw_data for r in wh.read("stg_rejected_records").collect()} == {'r2,o2,4,,"never closed,,', "r3,o3,1,,,,"}
