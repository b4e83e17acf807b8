"""Property tests: column expressions against plain-Python references."""

from decimal import ROUND_HALF_UP, Decimal

from hypothesis import given, settings
from hypothesis import strategies as st

from vitrine.functions import columns as C


def _initcap_reference(s):
    if s is None:
        return None
    out, prev_alnum = [], False
    for ch in s.lower():
        out.append(ch.upper() if not prev_alnum else ch)
        prev_alnum = ch.isalnum()
    return "".join(out)


texts = st.text(alphabet="abcXYZ09 -'.,éÃ", max_size=12)


@settings(max_examples=5, deadline=None)
@given(st.lists(st.one_of(st.none(), texts), min_size=1, max_size=200))
def test_initcap_words_matches_reference(spark, values):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, x string")
    got = {r.i: r.y for r in df.select("i", C.initcap_words("x").alias("y")).collect()}
    assert [got[i] for i in range(len(values))] == [_initcap_reference(v) for v in values]


@settings(max_examples=5, deadline=None)
@given(
    st.lists(
        st.tuples(st.integers(-10**12, 10**12), st.integers(0, 10**6), st.integers(0, 4)), min_size=1, max_size=200
    )
)
def test_round_ratio_is_exact_half_up(spark, rows):
    df = spark.createDataFrame([(i, n, d, k) for i, (n, d, k) in enumerate(rows)], "i int, n long, d long, k int")
    for k in range(5):
        part = df.filter(f"k = {k}").select("i", C.round_ratio("n", "d", k).alias("r")).collect()
        for r in part:
            _, n, d, _ = (r.i, *rows[r.i])
            if d == 0:
                assert r.r is None
            else:
                expected = (Decimal(n) / Decimal(d)).quantize(Decimal(1).scaleb(-k), rounding=ROUND_HALF_UP)
                assert r.r == expected, (n, d, k, r.r, expected)
