"""Table readers."""

from __future__ import annotations

from functools import cached_property

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from storelake import schemas

TEST_TABLES = ("region", "nation", "customer", "supplier", "part", "orders",
               "lineitem", "events", "documents", "embeddings", "pages",
               "benchmark", "labels", "conversations")


class Tables:
    """Lazy Parquet readers for the driver's test tables in ``root``.

    Each attribute is a plain ``spark.read.parquet`` -- Catalyst prunes the
    columns and pushes the filters of whatever query uses it into the scan.
    """

    def __init__(self, spark: SparkSession, root: str):
        self.spark = spark
        self.root = root.rstrip("/")
        self._frames: dict[str, DataFrame] = {}

    def read(self, name: str) -> DataFrame:
        """The table as a lazy DataFrame (one reader per table and instance:
        DataFrames are immutable, so every query may share it)."""
        if name not in self._frames:
            self._frames[name] = self.spark.read.parquet(f"{self.root}/{name}.parquet")
        return self._frames[name]

    def __getattr__(self, name: str) -> DataFrame:
        if name in TEST_TABLES:
            return self.read(name)
        raise AttributeError(name)

    @cached_property
    def bronze(self):
        from storelake.sources.bindings import Bronze
        return Bronze(self)


_SHARED: dict[tuple[int, str], Tables] = {}


def tables(spark: SparkSession, root: str) -> Tables:
    """One :class:`Tables` per (session, folder), so the readers and the
    bronze bindings are built once and shared by every query."""
    key = (id(spark), root.rstrip("/"))
    t = _SHARED.get(key)
    if t is None or t.spark is not spark:
        t = _SHARED[key] = Tables(spark, root)
    return t


def _raw_bronze(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A headered CSV as text columns named by its header (no inference pass)."""
    raw = spark.read.option("header", True).csv(f"{root.rstrip('/')}/{name}")
    missing = [c for c in schemas.BRONZE[name].names if c not in raw.columns]
    if missing:
        raise ValueError(f"{name}: the extract has no column {', '.join(missing)}; it has {', '.join(raw.columns)}")
    return raw


def _typed(f, ids: str):
    from pyspark.sql.types import StringType
    return StringType() if ids == "string" and f.name.endswith("_id") and f.name != "order_item_id" else f.dataType


def read_bronze(spark: SparkSession, root: str, name: str, ids: str = "string") -> DataFrame:
    """Read one headered bronze CSV (S1): declared columns by header name, in
    declared order; further columns are ignored and a missing one fails.

    ``ids`` is the type of the key columns: ``"string"`` as in raw extracts, or
    ``"declared"`` for the numeric keys of the test tables. Fields that don't
    fit their type become null; :func:`bronze_cast_failures` counts them.
    """
    raw = _raw_bronze(spark, root, name)
    return raw.select([F.col(f"`{f.name}`").try_cast(_typed(f, ids)).alias(f.name)
                       for f in schemas.BRONZE[name].fields])


def bronze_cast_failures(spark: SparkSession, root: str, name: str, ids: str = "string") -> DataFrame:
    """Per declared column the number of non-empty fields that don't fit its type."""
    raw = _raw_bronze(spark, root, name)
    bad = {f.name: F.count_if(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(_typed(f, ids)).isNull())
           for f in schemas.BRONZE[name].fields}
    row = raw.agg(*[c.alias(n) for n, c in bad.items()])
    return row.select(F.explode(F.array(*[F.struct(F.lit(n).alias("column_name"), F.col(n).alias("failed"))
                                          for n in bad])).alias("c")).select("c.*")


def bronze_rejects(spark: SparkSession, root: str, name: str, ids: str = "string") -> DataFrame:
    """The reject table of an extract: one row per non-empty field that doesn't fit its type, with the column, the
    text found and the whole row as JSON. The extract is read once."""
    raw = _raw_bronze(spark, root, name)
    fields = F.array(*[F.when(F.col(f"`{f.name}`").isNotNull() & F.col(f"`{f.name}`").try_cast(_typed(f, ids)).isNull(),
                              F.struct(F.lit(f.name).alias("column_name"), F.col(f"`{f.name}`").alias("value")))
                       for f in schemas.BRONZE[name].fields])
    bad = raw.select(F.explode(F.filter(fields, lambda x: x.isNotNull())).alias("f"),
                     F.to_json(F.struct("*")).alias("record"))
    return bad.select("f.column_name", "f.value", "record")


def read_geolocation(spark: SparkSession, root: str) -> DataFrame:
    """The geolocation extract, passed through as it is (text columns by header)."""
    return spark.read.option("header", True).csv(f"{root.rstrip('/')}/geolocation")


def read_daily_sales(spark: SparkSession, path: str) -> DataFrame:
    """Daily sales per category, the three forecast columns, complete rows only (S3)."""
    return (spark.read.parquet(path)
            .select("sale_date", "category_english", "num_orders")
            .na.drop())
