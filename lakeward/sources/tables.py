"""Readers for the driver's Parquet tables and for our own product tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

DRIVER_TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem",
                 "events", "documents", "embeddings", "pages", "benchmark", "labels",
                 "conversations")


def read_table(spark: SparkSession, sf_dir: str, name: str, columns: list[str] | None = None) -> DataFrame:
    """Read one driver table; selecting columns here lets the scan prune them."""
    df = spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")
    return df.select(*columns) if columns else df


def read_product(spark: SparkSession, path: str, schema: str | None = None,
                 fmt: str = "parquet") -> DataFrame:
    """Read a product table with an explicit schema, so partition values keep
    their declared types (``'007'`` stays a string)."""
    reader = spark.read.format(fmt)
    if schema:
        reader = reader.schema(schema)
    return reader.load(path)


class TableRegistry:
    """Resolve dotted product names (``silver.engagement_events``) to frames."""

    def __init__(self, spark: SparkSession, root: str | None = None):
        self.spark = spark
        self.root = root
        self._frames: dict[str, DataFrame] = {}

    def register(self, name: str, df: DataFrame) -> None:
        self._frames[name] = df

    def path_of(self, name: str) -> str:
        if self.root is None:
            raise KeyError(name)
        return f"{self.root.rstrip('/')}/{name.replace('.', '/')}"

    def get(self, name: str, schema: str | None = None) -> DataFrame:
        if name in self._frames:
            return self._frames[name]
        return read_product(self.spark, self.path_of(name), schema)

    def __contains__(self, name: str) -> bool:
        return name in self._frames
