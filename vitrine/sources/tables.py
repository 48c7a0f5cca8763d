"""Catalog readers (A1-A5, A13, U1, B1) and the products view of the test data."""

from __future__ import annotations

import functools

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from vitrine.functions.prices import clean_double
from vitrine.schema import CATALOG, Labels

TEST_TABLES = [
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
]


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def products(spark: SparkSession, sf_dir: str, labels: Labels = Labels("A", "B"), parity: int | None = None) -> DataFrame:
    """Products view over the driver tables: one product per part or vector.

    ``embeddings FULL JOIN part ON vec_id = p_partkey``: a part without a
    vector keeps a null vector, a vector without a part a null title, price
    and url. Even ids form the source catalog, odd ids the target catalog.
    ``name`` is the bare part name (a title shared by many listings, for
    de-duplication). ``parity`` gives one of the two catalogs, filtered on
    either side of the join.
    """
    e = read_table(spark, sf_dir, "embeddings").select("vec_id", "embedding")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_type", "p_retailprice")
    if parity is not None:
        even = F.col("vec_id") % 2 == 0, F.col("p_partkey") % 2 == 0
        e, p = (d.where(x if parity == 0 else ~x) for d, x in zip((e, p), even))
    j = e.join(p, e.vec_id == p.p_partkey, "full").withColumn("product_id", F.coalesce("vec_id", "p_partkey"))
    return j.select(
        "product_id",
        F.when(F.col("p_partkey").isNotNull(), F.concat_ws(" ", "p_name", "p_brand")).alias("title"),
        clean_double("p_retailprice").alias("price"),
        F.concat(F.lit("/p/"), F.col("p_partkey").cast("string")).alias("url"),
        F.when(F.col("product_id") % 2 == 0, F.lit(labels.source)).otherwise(F.lit(labels.target)).alias("marketplace"),
        F.col("p_type").alias("category"),
        F.col("embedding"),
        F.col("p_name").alias("name"),
    )


def split_catalogs(catalog: DataFrame, labels: Labels) -> tuple[DataFrame, DataFrame]:
    """Source and target catalogs of a combined listing (by marketplace)."""
    return (
        catalog.where(F.col("marketplace") == labels.source),
        catalog.where(F.col("marketplace") == labels.target),
    )


def scan_with_suffix(spark: SparkSession, table: str, alias: str, cols=("title", "price", "url")) -> DataFrame:
    """A1 + B1 + B4: ``title, price, url`` of a table renamed to
    ``<col>_<alias>``, rows without a title dropped. Stays a DataFrame."""
    df = spark.table(table)
    return df.select(*[F.col(c).alias(f"{c}_{alias}") for c in cols]).where(F.col(f"title_{alias}").isNotNull())


def scan_feed(spark: SparkSession, table: str) -> DataFrame:
    """A2 + B3: the internal feed projected and renamed, rows with a price
    and a title only."""
    return spark.sql(
        f"SELECT id AS id_tabela, title AS titulo_tabela, price AS preco_tabela, link AS url_tabela "
        f"FROM {table} WHERE price IS NOT NULL AND title IS NOT NULL"
    )


def scan_for_embedding(spark: SparkSession, table: str) -> DataFrame:
    """A3: ``title, price, url, categoria`` of a named table."""
    return spark.table(table).select("title", "price", "url", "categoria")


def union_tables(dfs) -> DataFrame:
    """Union by column name (one table per category, A4)."""
    return functools.reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), dfs)


def read_categories(spark: SparkSession, tables) -> DataFrame:
    """A4 + U1: several per-category tables read as one DataFrame."""
    return union_tables([spark.table(t) for t in tables])


def read_category_partitions(spark: SparkSession, path: str, categories, category_col: str = "category",
                             fmt: str = "parquet") -> DataFrame:
    """A4 + U1 over a table written by ``sinks.save_by_category``: one
    DataFrame per listed category, then one for every other category (or
    none), unioned by name. Each is a filter on the partition column, so
    its scan lists and reads only that category's folder: the union reads
    the table once, however many categories there are."""
    table = spark.read.format(fmt).load(path)
    cat = F.col(category_col)
    per = [table.where(cat == k) for k in categories]
    rest = table.where(~cat.isin(list(categories)) | cat.isNull())
    return union_tables(per + [rest])


def from_rows(spark: SparkSession, rows, schema=CATALOG) -> DataFrame:
    """A5: local rows with an explicit schema (fixtures only)."""
    return spark.createDataFrame(rows, schema=schema)


def list_tables(spark: SparkSession, database: str | None = None) -> DataFrame:
    """The catalog's tables as a DataFrame."""
    where = f" IN {database}" if database else ""
    return spark.sql(f"SHOW TABLES{where}")
