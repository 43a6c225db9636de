"""Tables of the session catalog: plain Parquet that every SQL user of the session reads by name."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tarnworks.sources import filesystem as fs


class NamedTable:
    """One table of a database. Rows are written to a folder of their own before the name moves to it, by one change in the
    catalog: readers find the old rows or the new ones at any moment, a job that fails leaves the old ones, and files that a reader
    has begun on stay until ``vacuum``. Only rows of another schema need the table to be dropped and declared again."""

    def __init__(self, spark: SparkSession, database: str, name: str, root: str):
        self.spark = spark
        self.database = database
        self.name = f"`{database}`.`{name}`"
        self.root = fs.qualified(spark, root)  # folder of the database
        self.folder = f"{self.root}/{name}"

    def exists(self) -> bool:
        return self.spark.catalog.databaseExists(self.database) and self.spark.catalog.tableExists(self.name)

    def read(self) -> DataFrame:
        return self.spark.table(self.name)

    def create(self, schema: T.StructType) -> NamedTable:
        """Declare an empty table; does nothing when the table is there."""
        if not self.exists():
            self.overwrite(self.spark.createDataFrame([], schema))
        return self

    def overwrite(self, df: DataFrame) -> int:
        """Replace all rows and the schema; returns the number of rows, counted in the stage that writes them."""
        folder = f"{self.folder}/{uuid.uuid4().hex}"
        seen = Observation()
        df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(folder)
        schema = T.StructType([T.StructField(f.name, f.dataType, True) for f in df.schema.fields])
        if self.exists() and self.spark.table(self.name).schema == schema:
            self.spark.sql(f"ALTER TABLE {self.name} SET LOCATION '{_quoted(folder)}'")
            return seen.get["rows"]
        self.spark.sql(f"CREATE DATABASE IF NOT EXISTS `{self.database}` LOCATION '{_quoted(self.root)}'")
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")  # an external table: its files stay
        self.spark.catalog.createTable(self.name, path=folder, source="parquet", schema=schema)
        return seen.get["rows"]

    def append(self, df: DataFrame) -> int:
        """Add rows, matched by column name, absent columns NULL; returns their number, counted in the stage that writes them."""
        fields = self.read().schema.fields
        unknown = set(df.columns) - {f.name for f in fields}
        if unknown:
            raise ValueError(f"columns not in the table: {sorted(unknown)}")
        seen = Observation()
        typed = df.select(*[
            (F.col(f.name) if f.name in df.columns else F.lit(None)).cast(f.dataType).alias(f.name) for f in fields
        ])
        typed.observe(seen, F.count(F.lit(1)).alias("rows")).write.insertInto(self.name)
        self.spark.catalog.refreshTable(self.name)
        return seen.get["rows"]

    def seed(self, df: DataFrame) -> int:
        """Fill the table if it has no rows; returns how many came in."""
        return self.append(df) if self.read().isEmpty() else 0

    def vacuum(self) -> None:
        """Remove the folders of earlier versions."""
        current = self.spark.sql(f"DESCRIBE EXTENDED {self.name}").where("col_name = 'Location'").first()["data_type"]
        for old in fs.list_names(self.spark, self.folder):
            if not current.endswith(f"/{old}"):
                fs.delete(self.spark, f"{self.folder}/{old}", recursive=True)


def _quoted(text: str) -> str:
    return text.replace("\\", "\\\\").replace("'", "\\'")
