"""Shared helpers of the corpus operators.

Input columns are renamed by position while an operator works, so that extra
columns (also ones that differ only in case, or carry the name of a result
column) can never clash; a result column replaces an input column of the same
name. Intermediate tables are written under the shared folder that
``spark.checkpoint.dir`` names, so a lost executor never loses them.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from vitrine.session import scratch_path

#: Words and white space of the operators' contracts: ASCII white space only.
WORD = r"[^\x20\x09-\x0D]+"


class Input:
    """A frame whose columns are renamed ``__in0, __in1, ...`` by position."""

    def __init__(self, df: DataFrame, **roles: str):
        names = df.columns
        self.names = names
        self.inner = [f"__in{i}" for i in range(len(names))]
        self.df = df.toDF(*self.inner)
        self._at = {role: self.inner[self._find(names, col)] for role, col in roles.items()}

    @staticmethod
    def _find(names: list[str], col: str) -> int:
        if col in names:
            return names.index(col)
        folded = [n.lower() for n in names]
        if col.lower() in folded:
            return folded.index(col.lower())
        raise ValueError(f"no column {col!r} in {names}")

    def name(self, role: str) -> str:
        return self._at[role]

    def __getitem__(self, role: str) -> Column:
        return F.col(self._at[role])

    def restore(self, df: DataFrame, results: dict[str, Column | str]) -> DataFrame:
        """The input's columns under their own names, then the results; a result replaces a column of its name."""
        new = {r.lower() for r in results}
        kept = [F.col(i).alias(n) for i, n in zip(self.inner, self.names) if n.lower() not in new]
        return df.select(*kept, *[(F.col(c) if isinstance(c, str) else c).alias(r) for r, c in results.items()])


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet in the shared folder and read back: cuts lineage, survives executors."""
    spark = df.sparkSession
    path = scratch_path(spark, name)
    df.write.option("compression", "zstd").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def bounded_sample(df: DataFrame, by: str, n: int) -> DataFrame:
    """At most ``n`` distinct rows, those of the smallest hashes of column ``by``; the same at every run.

    A hash bound first cuts the rows to those of a few times ``n`` values of
    ``by``. It comes from the (estimated) number of distinct values, so copies
    neither fill nor empty the sample.
    """
    total = df.agg(F.approx_count_distinct(F.xxhash64(by), 0.02)).first()[0]
    if total > 4 * n:
        cells = 1 << 32
        df = df.where(F.pmod(F.xxhash64(by), F.lit(cells)) < cells * 4 * n // total)
    return df.distinct().orderBy(F.xxhash64(by), by).limit(n)


def documents(spark: SparkSession, sf_dir: str, *cols: str) -> DataFrame:
    df = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return df.select(*cols) if cols else df


def crc_mod(col: Column, n: int) -> Column:
    """crc32 of the value as text, modulo ``n``; a null value counts as the empty text."""
    return F.pmod(F.crc32(F.coalesce(col.cast("string"), F.lit("")).cast("binary")), F.lit(n)).cast("int")


# ------------------------------------------------------------- Arrow stages

PIECE_BYTES = 4 << 20


def pieces(batch: pa.RecordBatch, text_index: int, limit: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each (a longer text is a slice of its own)."""
    sizes = pa.compute.binary_length(batch.column(text_index)).fill_null(0).to_pylist()
    start, total = 0, 0
    for i, n in enumerate(sizes):
        if i > start and total + n > limit:
            yield batch.slice(start, i - start)
            start, total = i, 0
        total += n
    if start < len(sizes):
        yield batch.slice(start)


def map_texts(
    df: DataFrame,
    text: str,
    keep: list[str],
    fields: list[T.StructField],
    make: Callable[[], Callable[[pa.Array], list]],
    limit: int = PIECE_BYTES,
) -> DataFrame:
    """Arrow stage over a text column: ``keep`` columns unchanged, plus ``fields`` computed per text.

    ``make`` runs once per task and returns the function from an Arrow string
    array (about ``limit`` bytes of text) to one list or Arrow array per field. Texts do
    not come back to the JVM unless ``keep`` names them.
    """
    cols = list(dict.fromkeys([*keep, text]))
    at, keep_at = cols.index(text), [cols.index(k) for k in keep]
    source = df.select(*cols)
    schema = T.StructType([source.schema[k] for k in keep] + fields)

    def run(batches):
        import pyarrow.compute  # noqa: F401  (pa.compute)
        from pyspark.sql.pandas.types import to_arrow_schema

        call, arrow = make(), to_arrow_schema(schema)
        for batch in batches:
            for piece in pieces(batch, at, limit):
                made = call(piece.column(at))
                arrays = [piece.column(i).cast(arrow.field(j).type) for j, i in enumerate(keep_at)]
                for f, v in zip(list(arrow)[len(keep_at):], made):
                    arrays.append(v.cast(f.type) if isinstance(v, pa.Array) else pa.array(v, f.type))
                yield pa.RecordBatch.from_arrays(arrays, schema=arrow)

    return source.mapInArrow(run, schema)


def utf8(column: pa.Array) -> list[bytes]:
    """The texts' bytes; null counts as the empty text."""
    return [b or b"" for b in column.cast(pa.binary()).to_pylist()]
