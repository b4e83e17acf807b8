"""Column expressions shared by all jobs.

All of these are built-in Spark expressions (no Python UDFs), so they run in
the JVM and, except for the higher-order ``initcap_words``, inside whole-stage
codegen.
"""

from __future__ import annotations

from itertools import chain

from pyspark.sql import Column
from pyspark.sql import functions as F

from vitrine.functions import lookups as L

# Parsed types. Money is parsed wide and rounded once, when it is narrowed on
# write (NUMBER(12,2) etc.). Coordinates are parsed wide too; those that fit the
# column's four integer digits keep 14 decimals until the centroid is rounded to 6.
MONEY_PARSE = "decimal(38,12)"
COORD_PARSE = "decimal(38,14)"
COORD_KEPT = "decimal(18,14)"
COORD_SCALE = 14
PRICE_TYPE = "decimal(12,2)"
ITEM_TOTAL_TYPE = "decimal(14,2)"
PAYMENT_TOTAL_TYPE = "decimal(14,2)"
AGG_MONEY_TYPE = "decimal(16,2)"
SUM_MONEY_TYPE = "decimal(38,2)"
COORD_TYPE = "decimal(10,6)"
AVG_SCORE_TYPE = "decimal(4,2)"
PCT_TYPE = "decimal(4,1)"


def _c(col: Column | str) -> Column:
    return F.col(col) if isinstance(col, str) else col


def _literal_map(mapping: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for x in chain.from_iterable(mapping.items())])


def state_name(state: Column | str) -> Column:
    """Full state name for a two-letter code (case-insensitive), else 'Unknown'."""
    return F.coalesce(_literal_map(L.STATE_NAMES)[F.upper(_c(state))], F.lit(L.UNKNOWN))


def region(state: Column | str) -> Column:
    """Macro-region of a state code (case-insensitive), else 'Unknown'."""
    by_state = {s: r for r, states in L.REGION_STATES.items() for s in states}
    return F.coalesce(_literal_map(by_state)[F.upper(_c(state))], F.lit(L.UNKNOWN))


# A word starts at a letter or digit that follows a non-alphanumeric (or the start).
_WORD_START = r"(?<![\p{L}\p{N}])(?=[\p{L}\p{N}])"


def initcap_words(text: Column | str) -> Column:
    """Capitalise the first letter of every word, lower-case the rest.

    Words are separated by any non-alphanumeric character ("d'oeste" ->
    "D'Oeste", "mogi-guacu" -> "Mogi-Guacu"); Spark's own ``initcap`` only
    splits on spaces.
    """
    pieces = F.split(F.lower(_c(text)), _WORD_START)
    capped = F.transform(pieces, lambda w: F.concat(F.upper(F.substring(w, 1, 1)), F.substring(w, 2, 1 << 30)))
    return F.array_join(capped, "")


def text_concat(*parts: Column | str) -> Column:
    """String concatenation where NULL behaves as the empty string."""
    return F.concat(*[F.coalesce(_c(p).cast("string"), F.lit("")) for p in parts])


def blank_to_null(text: Column | str) -> Column:
    """Empty text is NULL (sources other than the CSV reader keep '')."""
    t = _c(text)
    return F.when(t != "", t)


def parse_amount(text: Column | str) -> Column:
    """Money text -> decimal, NULL when not a number (no decimal-comma fix)."""
    return _c(text).try_cast(MONEY_PARSE)


def parse_amount_as(text: Column | str, kind: str) -> Column:
    """Money text rounded once to the column type ``kind``; NULL when not a number or too large for it."""
    return parse_amount(text).try_cast(kind)


def amount_overflows(text: Column | str, kind: str) -> Column:
    """Whether the text is a number that does not fit ``kind``."""
    return parse_amount(text).isNotNull() & parse_amount_as(text, kind).isNull()


def parse_coord(text: Column | str) -> Column:
    """Coordinate text with '.' or ',' as decimal mark -> decimal; NULL when invalid or too large (a reject rule)."""
    return F.regexp_replace(_c(text), ",", ".").try_cast(COORD_PARSE).try_cast(COORD_KEPT)


def parse_day(text: Column | str) -> Column:
    """First 10 characters of a timestamp text as a date; NULL when invalid."""
    return F.try_to_date(F.substring(_c(text), 1, 10), "y-M-d")


def date_key(day: Column | str) -> Column:
    """Date -> integer YYYYMMDD."""
    d = _c(day)
    return (F.year(d) * 10000 + F.month(d) * 100 + F.dayofmonth(d)).cast("int")


def to_date_key(text: Column | str) -> Column:
    """Timestamp text -> YYYYMMDD key, NULL for NULL or unparseable text."""
    return date_key(parse_day(text))


def category_group(category_en: Column | str) -> Column:
    """High-level group of an English category name; first listed match wins."""
    name = _c(category_en)
    expr = None
    for group, needles in L.CATEGORY_GROUPS:
        cond = None
        for needle in needles:
            hit = name.contains(needle)
            cond = hit if cond is None else (cond | hit)
        expr = F.when(cond, group) if expr is None else expr.when(cond, group)
    return expr.otherwise(L.OTHER_GROUP)


def sentiment(score: Column | str) -> Column:
    s = _c(score)
    return (
        F.when(s >= 4, L.SENTIMENT_POSITIVE)
        .when(s == 3, L.SENTIMENT_NEUTRAL)
        .otherwise(L.SENTIMENT_NEGATIVE)
    )


def yes_no(cond: Column) -> Column:
    return F.when(cond, "Y").otherwise("N")


def round_ratio(num: Column | str, den: Column | str, scale: int, num_scale: int = 0) -> Column:
    """Exact ``ROUND(num / den, scale)``, half away from zero, as a decimal.

    ``num`` is an integer or a decimal with ``num_scale`` fraction digits;
    ``den`` is a positive count. The division is done in integer arithmetic so
    the result does not depend on an intermediate decimal scale or on double
    rounding. NULL when ``den`` is 0 or NULL.
    """
    a = (_c(num) * F.lit(10**num_scale)).cast("decimal(38,0)")
    q = _c(den).cast("decimal(38,0)") * F.lit(10**num_scale)
    # |num/den| * 10^scale rounded half up == (2|a| 10^scale + q) div 2q
    mag = F.call_function("div", F.abs(a) * F.lit(2 * 10**scale) + q, q * F.lit(2))
    signed = F.when(a < 0, -mag).otherwise(mag).cast("decimal(20,0)")
    unit = F.lit(f"{10 ** -scale:.{scale}f}" if scale else "1").cast(f"decimal({scale + 1},{scale})")
    return F.when(_c(den) > 0, signed * unit)
