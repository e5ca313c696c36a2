"""Reading and writing tables, lists and archives."""

from __future__ import annotations

import io
import zipfile
from collections.abc import Callable, Iterator

import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import clean, display_text, nonblank, or_null, text_of
from .session import new_path

BOM = "\ufeff"
DASH = r"\s+[-–—]\s+"
#: Header names of a title, an artist and an album, in order of preference.
SYNONYMS = {"title": ["title", "track name", "track", "song", "song title", "name"], "artist": ["artist", "artist name", "artists", "artist name(s)", "channel"], "album": ["album", "album name", "release"]}


# --- sources

def read_csv(spark: SparkSession, path: str, columns: list[str] | None = None) -> DataFrame:
    """A CSV table with header, all strings; a byte-order mark is dropped. columns: the schema of a table that may be missing."""
    try:
        df = spark.read.option("header", True).option("multiLine", True).option("escape", '"').option("inferSchema", False).csv(path)
    except Exception as error:
        if columns is None or "PATH_NOT_FOUND" not in str(error):
            raise
        return spark.createDataFrame([], T.StructType([T.StructField(c, T.StringType()) for c in columns]))
    return df.toDF(*[c.lstrip(BOM) for c in df.columns]).na.fill("")


def typed(df: DataFrame, columns: dict[str, tuple[str, str]]) -> DataFrame:
    """header -> (column, kind: string, integer or real); blanks and bad numbers become null, 1995.0 is an integer."""
    cast = {"string": lambda c: or_null(c), "integer": lambda c: or_null(c).try_cast("double").try_cast("int"), "real": lambda c: or_null(c).try_cast("double")}
    return df.select([cast[kind](F.col(f"`{header}`")).alias(name) for header, (name, kind) in columns.items()])


def with_row_number(df: DataFrame, start: int = 2) -> DataFrame:
    """df with row_number in the order it is read. The rows are written once with their places, so that numbers stay whatever is computed again; partitions get offsets from their counts."""
    path = new_path(df.sparkSession, "placed")
    df.withColumn("_place", F.monotonically_increasing_id()).write.parquet(path)
    placed = df.sparkSession.read.parquet(path).withColumn("_part", F.shiftright("_place", 33))  # a place is a partition and 33 bits of a row
    sizes = placed.groupBy("_part").agg(F.count("*").alias("_n"))
    before = F.sum("_n").over(Window.orderBy("_part")) - F.col("_n")  # one row a partition
    offsets = sizes.select("_part", before.alias("_before"))
    number = F.col("_before") + F.col("_place").bitwiseAND((1 << 33) - 1) + F.lit(start)
    return placed.join(offsets, "_part").withColumn("row_number", number).select(*[F.col(f"`{c}`") for c in df.columns], "row_number")


def text_list(lines: DataFrame, value: str = "value") -> DataFrame:
    """Lines as title and artist: comments and blanks skipped; without a dash the line is a title."""
    line = clean(F.col(value))
    rows = lines.where((line != "") & ~line.rlike(r"^[#*]"))
    parts = F.split(line, DASH, 2)
    two = F.size(parts) == 2
    return rows.withColumns({"artist": F.when(two, F.trim(parts[0])).otherwise(""), "title": F.when(two, F.trim(F.get(parts, F.lit(1)))).otherwise(line)})


def playlist_lines(lines: DataFrame, value: str = "value", file_name: Column | None = None) -> DataFrame:
    """Lines of playlist files: stars stripped, split at a long dash or else a spaced hyphen; others are dropped. The playlist is the file's name."""
    line = clean(F.regexp_replace(F.col(value), r"\*", ""))
    parts = F.when(line.contains("—"), F.split(line, r"\s*—\s*", 2)).otherwise(F.split(line, " - ", 2))
    name = file_name if file_name is not None else F.col("_metadata.file_name")
    rows = lines.select("*", name.alias("_file"), parts.alias("_parts")).where(F.size("_parts") == 2)
    return rows.withColumns({"title": F.trim(F.get("_parts", F.lit(0))), "artist": F.trim(F.get("_parts", F.lit(1))), "playlist": F.regexp_replace(F.regexp_replace("_file", r"\.[^.]*$", ""), r"-videos$", "")}).drop("_file", "_parts")


def moved(spark: SparkSession, pattern: str, to: Callable[[int, str], str]) -> int:
    """Renames the files that a glob pattern finds: to gets a file's place and path. How many there were; their content is not read."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path
    fs = path(pattern).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    found = sorted(s.getPath().toString() for s in fs.globStatus(path(pattern)))
    for k, name in enumerate(found):
        new = path(to(k, name))
        fs.mkdirs(new.getParent())
        if not fs.rename(path(name), new):
            raise OSError(f"{name} is not renamed to {new}")
    return len(found)


def files_under(spark: SparkSession, path: str, extensions: tuple[str, ...] = ("csv", "txt", "zip")) -> DataFrame:
    """(path, extension, size, modified, content, sha256) of all files below a folder."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).load(path)
    extension = F.lower(F.regexp_extract("path", r"\.([^./]+)$", 1))
    return files.select("path", extension.alias("extension"), F.col("length").alias("size"), F.col("modificationTime").alias("modified"), "content", F.sha2("content", 256).alias("sha256")).where(F.col("extension").isin(list(extensions)))


def zip_members(files: DataFrame, extensions: tuple[str, ...] = (".csv", ".txt")) -> DataFrame:
    """(path, member, content) of the members of zip files; a bad archive gives none."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, content in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                try:
                    archive = zipfile.ZipFile(io.BytesIO(content.as_py()))
                except zipfile.BadZipFile:
                    continue
                for name in archive.namelist():  # one member at a time in memory
                    if name.lower().endswith(extensions):
                        yield pa.RecordBatch.from_arrays([pa.array([f"{path}::{name}"]), pa.array([name]), pa.array([archive.read(name)], pa.binary())], ["path", "member", "content"])

    return files.where(F.col("extension") == "zip").select("path", "content").mapInArrow(work, "path string, member string, content binary")


@F.pandas_udf(T.StringType())
def _cp1252(values: pd.Series) -> pd.Series:
    return values.map(lambda b: bytes(b).decode("cp1252", "replace"), na_action="ignore")


def decoded(content: Column) -> Column:
    """Bytes as text: UTF-8 without its mark if valid, else Windows-1252."""
    valid = F.is_valid_utf8(content.cast("string"))
    return F.when(valid, F.regexp_replace(content.cast("string"), f"^{BOM}", "")).otherwise(_cp1252(content))


def picked(df: DataFrame, names: list[str]) -> Column:
    """The first nonblank of the columns whose headers, in any case, are in names."""
    by = {c.strip().lower(): c for c in df.columns}
    found = [or_null(F.col(f"`{by[n]}`")) for n in names if n in by]
    return F.coalesce(*found, F.lit("")) if found else F.lit("")


def as_observations(df: DataFrame, synonyms: dict[str, list[str]] = SYNONYMS) -> DataFrame:
    """Rows of any header as title, artist, album and the raw cells as a map."""
    raw = F.map_from_arrays(F.array(*[F.lit(c) for c in df.columns]), F.array(*[text_of(F.col(f"`{c}`")) for c in df.columns]))
    return df.select(*[picked(df, names).alias(k) for k, names in synonyms.items()], raw.alias("raw"))


def table_if_present(spark: SparkSession, name: str) -> DataFrame | None:
    return spark.table(name) if spark.catalog.tableExists(name) else None


def patch_manifest(df: DataFrame, required: list[str]) -> DataFrame:
    """A manifest that has all its columns."""
    missing = [c for c in required if c not in df.columns]
    if missing:
        raise ValueError(f"manifest lacks columns: {', '.join(missing)}")
    return df.select(*[text_of(F.col(c)).alias(c) if c not in ("seq",) else F.col(c) for c in df.columns])


# --- sinks

def write_csv(df: DataFrame, path: str, fields: list[str] | None = None, *, display: bool = False, mode: str = "overwrite") -> None:
    """df as CSV with the fields in this order; display: cells as they should show."""
    names = fields or df.columns
    kinds = dict(df.dtypes)
    df.select([display_text(F.col(c)).alias(c) if display and kinds[c] == "string" else F.col(c) for c in names]).write.mode(mode).option("header", True).option("escape", '"').csv(path)


def write_summary(df: DataFrame, path: str) -> None:
    df.write.mode("overwrite").json(path)


def append_new(df: DataFrame, path: str, keys: list[str]) -> None:
    """Appends the rows whose keys the Parquet table lacks, each key once."""
    spark = df.sparkSession
    try:
        have = spark.read.parquet(path).select(*keys).distinct()
        df = df.join(have, keys, "left_anti")
    except Exception as error:
        if "PATH_NOT_FOUND" not in str(error) and "UNABLE_TO_INFER_SCHEMA" not in str(error):
            raise
    df.dropDuplicates(keys).write.mode("append").parquet(path)


def fingerprint(df: DataFrame) -> DataFrame:
    """One row that tells a table's content, whatever its order: rows, and two sums of row hashes."""
    h = F.xxhash64(*[F.col(f"`{c}`") for c in sorted(df.columns)])
    return df.agg(F.count("*").alias("n_rows"), F.coalesce(F.bit_xor(h), F.lit(0)).alias("hash_xor"), F.coalesce(F.sum(h.cast("decimal(38,0)")), F.lit(0)).cast("decimal(38,0)").alias("hash_sum"))


def flat_export(df: DataFrame, names: dict[str, str], notes: list[str], note: str = "notes") -> DataFrame:
    """Renamed columns, and several notes as one."""
    return df.select(*[F.col(a).alias(b) for a, b in names.items()], F.trim(F.concat_ws(" ", *[F.when(nonblank(F.col(c)), clean(F.col(c))) for c in notes])).alias(note))
