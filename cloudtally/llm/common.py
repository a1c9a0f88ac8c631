"""What the text operators share: the shared folder, written tables, rows with numbers, bounded Arrow batches."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Callable, Iterable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: Rows and bytes that one Arrow batch holds at most; a longer text is a batch of its own.
BATCH_ROWS = 1000
BATCH_BYTES = 8 << 20


def shared_folder(spark: SparkSession) -> str:
    """A new folder name under ``spark.checkpoint.dir``, which driver and executors share.

    Only a session on one machine may lack that setting (a test); it gets a folder for temporary files.
    """
    root = spark.conf.get("spark.checkpoint.dir", None)
    if not root:
        if not spark.sparkContext.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that driver and executors share")
        root = tempfile.gettempdir()
    return f"{root.rstrip('/')}/llm-{uuid.uuid4().hex}"


def written(df: DataFrame, folder: str | None = None, partition_by: Iterable[str] = (), **options: str) -> DataFrame:
    """``df`` written to the shared folder and read again: its lineage ends there, and lost executors cost nothing."""
    spark = df.sparkSession
    folder = folder or shared_folder(spark)
    schema = df.schema
    df.write.options(**{"compression": "zstd", **options}).partitionBy(*partition_by).parquet(folder)
    return spark.read.schema(schema).parquet(folder)


def numbered(docs: DataFrame, *columns: Column) -> DataFrame:
    """``place``, a number of each row's own, and ``columns``, written once.

    Rows that repeat an id, or have none, are told apart by it at every read: a number that a read works out anew
    depends on how many cores the splits of that read are packed for.
    """
    return written(docs.select(F.monotonically_increasing_id().alias("place"), *columns))


def bounded_batches(spark: SparkSession) -> None:
    """Keep Arrow batches of whole texts small, for this session from now on: plans read the setting when they run."""
    rows, size = (f"spark.sql.execution.arrow.{name}" for name in ("maxRecordsPerBatch", "maxBytesPerBatch"))
    if not 0 < int(spark.conf.get(rows)) <= BATCH_ROWS:
        spark.conf.set(rows, str(BATCH_ROWS))
    if spark.conf.get(size) != f"{BATCH_BYTES}b":
        spark.conf.set(size, f"{BATCH_BYTES}b")


def map_batches(df: DataFrame, function: Callable[[pa.RecordBatch], pa.RecordBatch], schema: str) -> DataFrame:
    """``mapInArrow`` with a function of one batch."""
    bounded_batches(df.sparkSession)

    def over(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                yield function(batch)

    return df.mapInArrow(over, schema)


def texts_of(column: pa.Array) -> list[str]:
    """Texts of a string column; null counts as empty."""
    return [text or "" for text in column.to_pylist()]


def bytes_of(column: pa.Array) -> list[bytes]:
    """UTF-8 bytes of a string column; null counts as empty."""
    return [text or b"" for text in column.cast(pa.binary()).to_pylist()]
