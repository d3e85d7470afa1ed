"""Warehouse tables on Parquet: read-or-empty, safe writes, lookup publishing.

Write modes never destroy what they read:

* ``append``   - insert-only tables (dimensions, batch log): only new files
                 are added; a failed job commits nothing.
* ``partitions`` - the fact: ``partitionBy("DateId")`` with dynamic
                 partition overwrite; only the partitions present in the
                 frame are replaced, at job commit.  A job killed within its
                 commit can leave a partition out: ``plans.publish`` applies
                 staged rows again until they are all there.
* ``overwrite`` - whole-table rebuild from sources other than the target
                 (date dimension, published lookups); refused when the plan
                 reads the target path.
"""

from __future__ import annotations

import posixpath
from dataclasses import dataclass
from urllib.parse import urlparse

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .. import schemas


#: Codec of what is written: figures, of which a warehouse has the most, take two thirds of the bytes that Spark's default does.
CODEC = "zstd"


def _condition(exc: AnalysisException) -> str | None:
    for getter in ("getCondition", "getErrorClass"):
        fn = getattr(exc, getter, None)
        if fn is not None:
            try:
                return fn()
            except Exception:  # pragma: no cover - older/newer API shapes
                continue
    return None


def _plain_path(uri: str) -> str:
    """Scheme-less, normalised path of a file URI or path (for comparing locations)."""
    parsed = urlparse(uri)
    return posixpath.normpath(parsed.path if parsed.scheme else uri).rstrip("/")


def read_or_empty(spark: SparkSession, path: str, schema: StructType) -> DataFrame:
    """The Parquet table at ``path`` read with ``schema``, or an empty frame of it.

    An existing but empty folder reads as 0 rows; a partitioned table is
    read with its partitions.  Only a missing path yields the empty frame;
    any other error is raised.
    """
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as exc:
        if _condition(exc) == "PATH_NOT_FOUND" or "PATH_NOT_FOUND" in str(exc):
            return spark.createDataFrame([], schema)
        raise


def write_table(df: DataFrame, path: str, mode: str, partition_by: str | None = None) -> None:
    """Write ``df`` as Parquet at ``path`` (see module doc for the modes)."""
    writer = df.write.format("parquet").option("compression", CODEC)
    if mode == "append":
        writer = writer.mode("append")
        if partition_by:
            writer = writer.partitionBy(partition_by)
    elif mode == "partitions":
        if not partition_by:
            raise ValueError("partition overwrite needs a partition column")
        writer = writer.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy(partition_by)
    elif mode == "overwrite":
        target = _plain_path(path) + "/"
        if any(_plain_path(f).startswith(target) for f in df.inputFiles()):
            raise ValueError(f"refusing to overwrite {path}: the frame reads from it")
        writer = writer.mode("overwrite")
        if partition_by:
            writer = writer.partitionBy(partition_by)
    else:
        raise ValueError(f"unknown write mode {mode!r}")
    writer.save(path)


def publish_lookup(df: DataFrame, primary_path: str, copy_path: str) -> None:
    """Publish one lookup to two places (warehouse + raw copy).

    The frame is computed once; the copy is read back from the first write,
    so an expensive lookup is never evaluated twice.
    """
    write_table(df, primary_path, "overwrite")
    spark = df.sparkSession
    write_table(spark.read.parquet(primary_path), copy_path, "overwrite")


@dataclass(frozen=True)
class Warehouse:
    """Paths of one warehouse (all under a shared root)."""

    root: str

    @property
    def product(self) -> str:
        return f"{self.root}/tables/product"

    @property
    def retailer(self) -> str:
        return f"{self.root}/tables/retailer"

    @property
    def sales(self) -> str:
        return f"{self.root}/tables/sales"

    @property
    def date(self) -> str:
        return f"{self.root}/tables/date"

    @property
    def sku_mapper(self) -> str:
        return f"{self.root}/lookups/sku_mapper"

    @property
    def sku_mapper_raw(self) -> str:
        return f"{self.root}/lookups/sku_mapper_raw"

    @property
    def batch(self) -> str:
        return f"{self.root}/control/batch"

    @property
    def key_exceptions(self) -> str:
        return f"{self.root}/control/key_exceptions"

    @property
    def properties(self) -> str:
        return f"{self.root}/control/properties"

    @property
    def runs(self) -> str:
        return f"{self.root}/control/runs"

    @property
    def lease(self) -> str:
        return f"{self.root}/control/lease"

    @property
    def raw_extracts(self) -> str:
        return f"{self.root}/deliveries"

    def stage(self, run: str) -> str:
        """Folder of one run's rows before they are published."""
        return f"{self.root}/staging/{run}"

    def key_bits(self, spark: SparkSession, wanted: int | None, default: int) -> int:
        """Id width of this warehouse, stored when it is first used; another ``wanted`` one is refused."""
        stored = read_or_empty(spark, self.properties, schemas.PROPERTIES).where("Name = 'key_bits'").select("Value").first()
        if stored is None:
            bits = wanted or default
            write_table(spark.createDataFrame([("key_bits", bits)], schemas.PROPERTIES), self.properties, "append")
            return bits
        if wanted and wanted != stored["Value"]:
            raise ValueError(f"the warehouse has ids of {stored['Value']} bits, not {wanted}")
        return int(stored["Value"])

    def read_key_exceptions(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.key_exceptions, schemas.KEY_EXCEPTIONS)

    def read_product(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.product, schemas.PRODUCT)

    def read_retailer(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.retailer, schemas.RETAILER)

    def read_sales(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.sales, schemas.SALES)

    def read_sales_history(self, spark: SparkSession) -> DataFrame:
        """The fact with the deliveries behind each row; ``read_sales`` leaves that column unread."""
        return read_or_empty(spark, self.sales, schemas.SALES_WITH_HISTORY)

    def read_date(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.date, schemas.DATE_DIM)

    def read_sku_mapper(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.sku_mapper, schemas.SKU_MAPPER)

    def read_batches(self, spark: SparkSession) -> DataFrame:
        return read_or_empty(spark, self.batch, schemas.BATCH)
