"""Constraints enforced while a table is loaded.

``gate`` looks at rows between compute and publish and names the first
constraint that a row breaks. The caller writes the result once, split by
``ok``, and publishes only the rows that keep all constraints; the others go to
the reject table, or fail the step, as the run's policy says.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from vitrine.session import scratch_path


class ConstraintViolation(ValueError):
    pass


@dataclass(frozen=True)
class Required:
    """The columns hold no NULL."""

    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Unique:
    """No other row has the same values in the columns (rows with a NULL there are not compared)."""

    name: str
    columns: tuple[str, ...]


@dataclass(frozen=True)
class Parent:
    """A row of ``parent`` has the values in its ``parent_columns`` (rows with a NULL there are not checked)."""

    name: str
    columns: tuple[str, ...]
    parent: DataFrame
    parent_columns: tuple[str, ...]


Rule = Required | Unique | Parent


def _known(columns: Sequence[str]) -> Column:
    return reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])


def _marked(rows: DataFrame, keys: DataFrame, columns: Sequence[str], mark: str, null_safe: bool = False) -> DataFrame:
    """``rows`` with the last column of ``keys`` as ``mark`` where their key is among ``keys`` (unique), else NULL."""
    renamed = keys.toDF(*[f"{mark}{i}" for i in range(len(columns))], mark)
    pairs = [(rows[c], renamed[f"{mark}{i}"]) for i, c in enumerate(columns)]
    same = reduce(lambda a, b: a & b, [x.eqNullSafe(y) if null_safe else x == y for x, y in pairs])
    return rows.join(renamed, same, "left").drop(*renamed.columns[:-1])


def _kept(keys: DataFrame) -> DataFrame:
    """Keys written once, so that the plan knows their size: a few are broadcast, and the rows need no exchange."""
    path = scratch_path(keys.sparkSession, "broken-keys")
    keys.write.parquet(path)
    return keys.sparkSession.read.schema(keys.schema).parquet(path)


Judged = list[tuple[int, Unique | Parent]]  # rules with their place in the list of rules


def _together(rules: Sequence[Rule]) -> list[tuple[tuple[str, ...], Judged]]:
    """Rules that compare keys, by the columns of the widest rule that has all of theirs."""
    keyed = [(i, r) for i, r in enumerate(rules) if not isinstance(r, Required)]
    groups: list[tuple[tuple[str, ...], Judged]] = []
    for i, rule in sorted(keyed, key=lambda x: -len(x[1].columns)):
        home = next((judged for columns, judged in groups if set(rule.columns) <= set(columns)), None)
        if home is None:
            groups.append((rule.columns, [(i, rule)]))
        else:
            home.append((i, rule))
    return groups


def _broken(rows: DataFrame, columns: Sequence[str], judged: Judged) -> DataFrame:
    """The keys in ``columns`` that break a rule of ``judged``, each once, with the place of the first such rule."""
    keys, arms = rows.groupBy(*columns).agg(F.count(F.lit(1)).alias("_n")), []
    for i, rule in sorted(judged, key=lambda x: x[0]):
        known, mark = _known(rule.columns), f"_rule{i}_"
        if isinstance(rule, Parent):
            asked = rows.where(known).select(*[F.col(c).alias(p) for c, p in zip(rule.columns, rule.parent_columns)])
            there = rule.parent.select(*rule.parent_columns).join(asked.distinct(), list(rule.parent_columns), "left_semi")
            keys = _marked(keys, there.distinct().withColumn("_mark", F.lit(True)), rule.columns, mark)
            arms.append(F.when(F.col(mark).isNull() & known, F.lit(i)))
        elif set(rule.columns) == set(columns):
            arms.append(F.when((F.col("_n") > 1) & known, F.lit(i)))
        else:
            counted = keys.where(known).groupBy(*rule.columns).agg((F.sum("_n") > 1).alias("_mark"))
            keys = _marked(keys, counted.where("_mark"), rule.columns, mark)
            arms.append(F.when(F.col(mark), F.lit(i)))
    return keys.select(*columns, F.coalesce(*arms).alias("_first")).where("_first IS NOT NULL")


def gate(rows: DataFrame, rules: Sequence[Rule]) -> DataFrame:
    """``rows`` with the column ``violation``: the name of the first rule of ``rules`` that a row breaks, or NULL.

    Every row of a key that occurs twice breaks its ``Unique`` rule. Keys are
    counted with a partial aggregate, so a key of very many rows is one row a
    task, and judged without the other columns: rules whose columns are among
    those of another rule are judged with it. Only the keys that break a rule,
    written to scratch, meet the rows, in one join for such a set of rules that
    is broadcast when they are few and split when a key is hot. ``rows`` is read
    several times, so it should be a written table.
    """
    out, firsts = rows, []
    for columns, judged in _together(rules):
        mark = f"_first{judged[0][0]}_"
        # A key may be unknown in columns that only the other rules look at.
        mixed = any(set(rule.columns) != set(columns) for _, rule in judged)
        out = _marked(out, _kept(_broken(rows, columns, judged)), columns, mark, null_safe=mixed)
        firsts.append(F.col(mark))
    firsts += [F.when(~_known(r.columns), F.lit(i)) for i, r in enumerate(rules) if isinstance(r, Required)]
    first = F.least(*firsts) if len(firsts) > 1 else (firsts or [F.lit(None)])[0]
    names = [F.when(first == i, F.lit(r.name)) for i, r in enumerate(rules)]
    violation = F.coalesce(*names) if names else F.lit(None).cast("string")
    return out.select(*rows.columns, violation.alias("violation"))


def write_split(gated: DataFrame, path: str) -> None:
    """Write gated rows once, those that keep all rules under ``ok=true``, the others under ``ok=false``."""
    gated.withColumn("ok", F.col("violation").isNull()).write.partitionBy("ok").parquet(path)


def violations(gated: DataFrame, columns: Sequence[str]) -> DataFrame:
    """(constraint_name, key_value, occurrences) of the rows that break a rule."""
    key = F.concat_ws("-", *[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in columns])
    return (
        gated.where(F.col("violation").isNotNull())
        .groupBy(F.col("violation").alias("constraint_name"), key.alias("key_value"))
        .agg(F.count(F.lit(1)).alias("occurrences"))
    )
