"""Helpers that the operators of this subpackage share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..sources.session import new_path, ship_code

#: Word separators: space, tab, line feed, vertical tab, form feed, carriage return.
SPACES = " \t\n\x0b\x0c\r"
SPACE_RUN = r"[\x20\x09-\x0D]+"
MIN_FILES, ROWS_A_FILE = 6, 100_000


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship_code(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame) -> DataFrame:
    """df written as Parquet into the shared folder and read again: its lineage is cut, and a lost executor loses none of it."""
    spark = df.sparkSession
    path = new_path(spark, "curatrix")
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def compact(df: DataFrame, rows: int) -> DataFrame:
    """stored(df), in as few files as a table of about so many rows needs: rounds over small tables are then few tasks each."""
    return stored(df.coalesce(max(MIN_FILES, -(-rows // ROWS_A_FILE))))


def let(value: Column, body) -> Column:
    """body(value) with value evaluated once, however often body names it."""
    return F.get(F.transform(F.array(value), body), F.lit(0))


def once(df: DataFrame, columns: dict[str, Column]) -> DataFrame:
    """df with these columns (replacing those of the same names), each evaluated once a row: the optimiser copies no expression past a generator."""
    kept = [F.col(f"`{c}`") for c in df.columns if c not in columns]
    return df.select(*kept, F.inline(F.array(F.struct(*[c.alias(k) for k, c in columns.items()]))))


def words_of(text: Column) -> Column:
    """The words of a text (null: none), in order."""
    return F.array_remove(F.split(F.coalesce(text, F.lit("")), SPACE_RUN), "")
