"""Small helpers shared by the operators of this package."""

from __future__ import annotations

import uuid
from collections.abc import Callable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from acctflow.session import ensure_checkpoint_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def shared_folder(spark: SparkSession, tag: str) -> str:
    """A new folder name under the checkpoint folder that all executors share."""
    return f"{ensure_checkpoint_dir(spark).rstrip('/')}/acctflow/{tag}-{uuid.uuid4().hex}"


def delete_folder(spark: SparkSession, path: str) -> None:
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def written(df: DataFrame, path: str) -> DataFrame:
    """``df`` written once as Parquet at ``path`` and read back."""
    df.write.mode("error").parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def text_or_empty(name: str = "text") -> F.Column:
    return F.coalesce(F.col(name).cast("string"), F.lit(""))


class BoundedCache(dict):
    """Memo of a pure function of short strings, in two generations of at most
    ``size`` entries: a full one becomes the old one, from which keys in use
    come back.

    A memory bound only: a forgotten entry is computed again with the same
    result. ``dict.__getitem__`` calls ``__missing__``, so ``map`` over it
    stays in C for hits.
    """

    def __init__(self, compute: Callable, size: int = 200_000, longest: int = 64):
        super().__init__()
        self._compute, self._size, self._longest, self._old = compute, size, longest, {}

    def __missing__(self, key):
        if len(key) > self._longest:
            return self._compute(key)
        value = self._old[key] if key in self._old else self._compute(key)
        if len(self) >= self._size:
            self._old = dict(self)
            self.clear()
        self[key] = value
        return value


def arrow_rows(
    rows_of: Callable[[Iterator[pa.RecordBatch]], Iterator[dict]], schema: pa.Schema, per_batch: int = 2000,
    max_bytes: int = 8 << 20,
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Adapter for ``mapInArrow``: ``rows_of`` yields dicts, which go out in
    batches bounded by rows and by the bytes of their texts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out: list[dict] = []
        held = 0
        for row in rows_of(batches):
            out.append(row)
            held += sum(len(v) for v in row.values() if isinstance(v, (str, bytes)))
            if len(out) >= per_batch or held >= max_bytes:
                yield pa.RecordBatch.from_pylist(out, schema=schema)
                out, held = [], 0
        if out:
            yield pa.RecordBatch.from_pylist(out, schema=schema)

    return run


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", max_bytes: int = 8 << 20) -> Iterator[pa.RecordBatch]:
    """The same rows in slices whose texts hold about ``max_bytes`` (a longer
    text is a slice of its own), so that a task's Python copies stay small."""
    for batch in batches:
        column = batch.column(batch.schema.get_field_index(text))
        size = pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist()
        start, held = 0, 0
        for i, n in enumerate(size):
            if held and held + n > max_bytes:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += n
        if start < batch.num_rows:
            yield batch.slice(start)


def with_columns_of_text(
    df: DataFrame, text_col: str, keep: tuple[str, ...], added: str, make: Callable[[], Callable[[list[str]], list[pa.Array]]],
    max_bytes: int = 4 << 20,
) -> DataFrame:
    """The columns ``keep`` of ``df`` and those of the schema ``added``, which a
    function of a list of texts gives as arrays; ``make`` builds it once a task.
    A null text counts as empty. The text crosses to Python once, kept or not."""
    taken = [F.col(c) for c in keep]
    if text_col not in keep or df.schema[text_col].dataType.typeName() != "string":
        taken.append(F.col(text_col).cast("string").alias("__text"))
    narrow = df.select(*taken)
    source = "__text" if "__text" in narrow.columns else text_col
    at, n = narrow.columns.index(source), len(keep)
    names = [c.strip().rsplit(" ", 1)[0] for c in added.split(",")]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        of_texts = make()
        for batch in pieces(batches, source, max_bytes):
            arrays = of_texts([t or "" for t in batch.column(at).to_pylist()])
            yield pa.RecordBatch.from_arrays([*batch.columns[:n], *arrays], names=[*keep, *names])

    held = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in narrow.schema.fields[:n])
    return narrow.mapInArrow(run, f"{held}, {added}")
