"""Helpers shared by the operators: scratch tables in the shared checkpoint
folder, the held-out fold and ASCII-exact word splitting."""

from __future__ import annotations

import ctypes
import gc
import uuid

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from shelfline.session import checkpoint_dir, ship_package
from shelfline.sources.tables import table_path

#: Rows handed to Python at a time by the text operators (bounds the memory
#: of a worker when texts are long).
SLICE_ROWS = 256

#: Bytes of a batch of rows on its way to Python.
BATCH_BYTES = 6 << 20
_BATCH, _BATCH_DEFAULT = "spark.sql.execution.arrow.maxBytesPerBatch", "67108864b"

FOLDS = 5


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "documents"))


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(table_path(sf_dir, "labels"))


def session_of(df: DataFrame) -> SparkSession:
    return df.sparkSession


def prepare_python(spark: SparkSession) -> None:
    """Make this package importable in the executors' Python workers, and let rows go
    to them in batches of BATCH_BYTES (unless the session says otherwise), so that a
    worker's memory does not depend on how long the texts are."""
    ship_package(spark)
    if spark.conf.get(_BATCH, _BATCH_DEFAULT) == _BATCH_DEFAULT:
        spark.conf.set(_BATCH, str(BATCH_BYTES))


def release() -> None:
    """Give freed memory back to the system.  An executor's Python workers outlive
    their tasks and wait, idle, beside the JVM; so does the driver's Python."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):                   # another C library
        pass


class Scratch:
    """Tables written once and read back: they cut lineage and survive lost
    executors because they lie in the folder that ``spark.checkpoint.dir``
    names.  ``drop`` removes a table no later plan reads."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.base = f"{checkpoint_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex[:12]}"

    def path(self, table: str) -> str:
        return f"{self.base}/{table}"

    def write(self, df: DataFrame, table: str) -> DataFrame:
        path = self.path(table)
        df.write.mode("overwrite").option("compression", "zstd").parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    def drop(self, *tables: str) -> None:
        """Remove tables; without names all of them."""
        jvm = self.spark.sparkContext._jvm
        conf = self.spark.sparkContext._jsc.hadoopConfiguration()
        for path in [self.path(t) for t in tables] or [self.base]:
            p = jvm.org.apache.hadoop.fs.Path(path)
            p.getFileSystem(conf).delete(p, True)


def fold_of(doc_id: Column) -> Column:
    """crc32 of the id's decimal text modulo 5 (0: held out).  A null id
    counts as the empty text."""
    return F.crc32(F.coalesce(doc_id.cast("string"), F.lit("")).cast("binary")) % FOLDS


def held_out(doc_id: Column) -> Column:
    return fold_of(doc_id) == 0


def words_of(text: str | None) -> list[bytes]:
    """Words ``[^\\x20\\x09-\\x0D]+`` as UTF-8 bytes (``bytes.split`` splits on
    exactly those six characters)."""
    return (text or "").encode("utf-8", "surrogatepass").split()


def crc32_sql(text: str) -> str:
    """DuckDB SQL for the unsigned crc32 of a text's UTF-8 bytes (null: null):
    bit by bit with the reversed polynomial 0xEDB88320."""
    step = "CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END"
    return (f"xor(list_reduce(list_transform(range(1, 2 * strlen({text}), 2), lambda k: "
            f"('0x' || substr(hex(encode({text})), k, 2))::BIGINT), "
            f"lambda a, b: list_reduce(range(8), lambda c, i: {step}, xor(a, b)), 4294967295::BIGINT), 4294967295)")
