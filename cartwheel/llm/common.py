"""Helpers that several operators share."""

from __future__ import annotations

import gc
import os
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cartwheel.session import remove_path, scratch_path

# Bytes of text that one Python step holds at a time.  A longer text is a
# chunk of its own.
CHUNK_BYTES = 2 << 20


def importable(spark: SparkSession) -> None:
    """Lets Python workers find this package where it lies beside the driver
    and is not installed or shipped (``--py-files``)."""
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    paths = spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep)
    if root not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([root, *filter(None, paths)])


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    importable(spark)
    return spark.read.parquet(f"{folder}/{name}.parquet")


def stored(df: DataFrame, label: str) -> DataFrame:
    """Written to the shared folder and read back: cuts the lineage, so that a
    lost executor costs the lost files' tasks at most."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def released(*tables: DataFrame, spark: SparkSession | None = None) -> None:
    """Removes the files of tables of ``stored`` that nothing reads any more, and
    has the driver look for shuffles that nothing refers to, whose files then go
    too: a long chain of steps keeps only what its next step needs."""
    for table in tables:
        spark = table.sparkSession
        for path in {name.rpartition("/")[0] for name in table.inputFiles()}:
            remove_path(spark, path)
    gc.collect()
    spark._jvm.System.gc()


def chunks(batches: Iterator[pa.RecordBatch], text: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batches with about ``limit`` bytes of text each."""
    for batch in batches:
        if not batch.num_rows:
            continue
        column = batch.column(batch.schema.get_field_index(text))
        size = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
        start, held = 0, 0
        for i, n in enumerate(size):
            if i > start and held + n > limit:
                yield batch.slice(start, i - start)
                start, held = i, 0
            held += int(n)
        yield batch.slice(start)


def joined_texts(column: pa.Array) -> tuple[bytes, list[int]]:
    """All texts of a column as one buffer of bytes, with the n + 1 offsets;
    NULL counts as empty."""
    texts = [b"" if t is None else t for t in pc.cast(column, pa.binary()).to_pylist()]
    offsets = [0]
    for t in texts:
        offsets.append(offsets[-1] + len(t))
    return b"".join(texts), offsets


def id_remainder(key: str, parts: int) -> Column:
    """Fold of a row: crc32 of the id written as text, modulo ``parts``."""
    return F.crc32(F.col(key).cast("string").cast("binary")) % parts
