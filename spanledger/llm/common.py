"""What the operators of this subpackage share: reading tables, keyed texts, Arrow rows."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def vocabulary_path(vocabulary: str) -> str:
    """The file of a vocabulary: a path as it is, a bare name where the package of public vocabularies is installed. Asked on the
    machine that opens it."""
    if "/" in vocabulary:
        return vocabulary
    import public_tokenizers

    return public_tokenizers.path(vocabulary)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Only the id and the text (null: empty), so that other columns of ``docs`` never clash with results."""
    return docs.select(
        F.col(id_col).cast("long").alias("doc_id"), F.coalesce(F.col(text_col).cast("string"), F.lit("")).alias("text")
    )


def whole_row(docs: DataFrame, name: str = "doc") -> Column:
    """All columns of ``docs`` in one struct, so that no name of theirs clashes with a column added beside it."""
    return F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias(name)


def arrow_schema(schema: T.StructType) -> pa.Schema:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "string": pa.string(), "boolean": pa.bool_(),
             "double": pa.float64(), "binary": pa.binary(), "array<string>": pa.list_(pa.string()),
             "array<bigint>": pa.list_(pa.int64()), "array<binary>": pa.list_(pa.binary())}
    return pa.schema([(f.name, kinds[f.dataType.simpleString()]) for f in schema])


def batches_of(rows: Iterable[tuple], schema: pa.Schema, size: int = 4096) -> Iterator[pa.RecordBatch]:
    """Rows in Arrow batches of at most ``size`` rows."""
    held: list[tuple] = []
    for row in rows:
        held.append(row)
        if len(held) >= size:
            yield _batch(held, schema)
            held = []
    if held:
        yield _batch(held, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.record_batch([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


def map_rows(df: DataFrame, rows_of, ddl: str) -> DataFrame:
    """``rows_of``: from an iterator of Arrow batches to result tuples; runs per partition with bounded batches."""
    schema = T.StructType.fromDDL(ddl)
    arrow = arrow_schema(schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return batches_of(rows_of(batches), arrow)

    return df.mapInArrow(run, schema)


class WordCache(dict):
    """Values by word, computed by ``fill`` when missing. Holds at most two generations of ``limit`` words: the words
    used since the last turn stay, the others are dropped, so that memory does not grow with the corpus."""

    def __init__(self, fill, limit: int = 200_000):
        super().__init__()
        self.fill, self.limit, self.old = fill, limit, {}

    def __missing__(self, word):
        value = self.old.get(word)
        if value is None:
            value = self.fill(word)
        if len(self) >= self.limit:
            self.old = dict(self)
            self.clear()
        self[word] = value
        return value


def sample_by_dim(vectors: DataFrame, sizes: dict[int, int], wanted: int, id_col: str, columns: list[str]) -> list:
    """At most ``wanted`` rows of each vector length ``dim``, those with the smallest hash of ``id_col``, for the driver.

    A threshold on the hash first leaves about twice as many of each length, whatever its number of rows (``sizes``).
    """
    if not sizes:
        return []
    bounds = {d: min(1 << 30, max(1, (1 << 30) * 2 * wanted // n)) for d, n in sizes.items()}
    bound = F.element_at(F.create_map(*[F.lit(x) for pair in bounds.items() for x in pair]), F.col("dim"))
    by_chance = Window.partitionBy("dim").orderBy(F.xxhash64(id_col), id_col)
    return (
        vectors.filter(F.pmod(F.xxhash64(id_col), F.lit(1 << 30)) <= bound)
        .withColumn("_place", F.row_number().over(by_chance)).filter(F.col("_place") <= wanted).select(*columns).collect()
    )
