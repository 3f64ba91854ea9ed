"""Reading the tables and handing texts to Arrow functions."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: ASCII white space, as the contracts define it.
SPACE = r"[\x20\x09-\x0D]+"
#: Words that a worker remembers, in each of two generations.
REMEMBERED_WORDS = 150_000


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(column: pa.Array) -> Iterator[bytes]:
    """UTF-8 bytes of a string column, one at a time; null counts as empty."""
    for value in column.cast(pa.binary()):
        yield b"" if not value.is_valid else value.as_py()


def one_row_each(docs: DataFrame) -> DataFrame:
    """Of the rows with one ``doc_id`` the one with the smallest hash over all columns; rows without an id go."""
    columns = [F.col(c) for c in docs.columns]
    hashed = [F.col(c) for c, kind in docs.dtypes if not kind.startswith("map")]
    rows = docs.filter(F.col("doc_id").isNotNull()).groupBy("doc_id")
    return rows.agg(F.min_by(F.struct(*columns), F.xxhash64(*hashed)).alias("row")).select("row.*")


def map_rows(
    frame: DataFrame,
    rows: Callable[[Iterator[dict]], Iterable[tuple]],
    schema: str,
    batch_rows: int = 2000,
) -> DataFrame:
    """Apply ``rows`` to every partition as an iterator of dicts.

    The column ``text`` arrives as UTF-8 bytes (null as empty); results leave in batches of at
    most ``batch_rows`` rows or about 16 MB.
    """
    names = frame.columns
    spark_schema = frame.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(spark_schema)

    def run(batches):
        def dicts():
            for batch in batches:
                for start in range(0, batch.num_rows, batch_rows):
                    part = batch.slice(start, batch_rows)
                    columns = []
                    for name, column in zip(names, part.columns, strict=True):
                        columns.append(list(texts_of(column)) if name == "text" else column.to_pylist())
                    for values in zip(*columns, strict=True):
                        yield dict(zip(names, values, strict=True))

        pending: list[tuple] = []
        held = 0
        for row in rows(dicts()):
            pending.append(row)
            held += sum(len(v) * (8 if isinstance(v, list) else 1) for v in row if isinstance(v, (bytes, str, list)))
            if len(pending) >= batch_rows or held >= 1 << 24:
                yield _batch(pending, arrow)
                pending, held = [], 0
        if pending:
            yield _batch(pending, arrow)

    return frame.mapInArrow(run, spark_schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True))
    return pa.RecordBatch.from_arrays(
        [pa.array(values, type=field.type) for values, field in zip(columns, schema, strict=True)], schema=schema
    )


class Remembered(dict):
    """Result of ``make`` per word. When full, it becomes the older generation, from which words come back."""

    def __init__(self, make):
        super().__init__()
        self.make = make
        self.older: dict = {}

    def __missing__(self, word):
        if len(self) >= REMEMBERED_WORDS:
            self.older = dict(self)
            self.clear()
        value = self.older.get(word)
        if value is None:
            value = self.make(word)
        self[word] = value
        return value
