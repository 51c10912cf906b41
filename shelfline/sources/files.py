"""Scans: parquet, CSV, JSON and text files, with their provenance."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from shelfline.plans.ordered import cut_lineage


def read_folder(
    spark: SparkSession, folder: str, name_glob: str = "*.parquet", recursive: bool = False, provenance: bool = True,
    schema: str | T.StructType | None = None, merge_schemas: bool = False,
) -> DataFrame:
    """All parquet files of a folder as one table; columns of the schema missing in a file are null.

    Declare the schema where files differ. Without one the first file's counts, or, with
    `merge_schemas`, that of all files, for which every footer is read. The file name rides along from
    the scan's metadata, so a per-file rule can use it as a group key.
    """
    reader = spark.read.option("pathGlobFilter", name_glob).option("recursiveFileLookup", str(recursive).lower())
    reader = reader.schema(schema) if schema is not None else reader.option("mergeSchema", str(merge_schemas).lower())
    df = reader.parquet(folder)
    return df.select("*", F.col("_metadata.file_name").alias("file_name")) if provenance else df


def read_reused(spark: SparkSession, path_glob: str, *columns: str) -> DataFrame:
    """The named columns of a glob as one written table, for several uses."""
    return cut_lineage(spark.read.parquet(path_glob).select(*columns))


def read_delimited(
    spark: SparkSession, path: str, schema: str, sep: str = ",", drop: tuple[str, ...] = (), line_ends_in_cells: bool = False
) -> DataFrame:
    """Header CSV/TSV with a declared schema; quoted cells may hold quotes and separators.

    Files are split over tasks by line. Only where quoted cells hold line ends must a file be read
    whole by one task: say so with `line_ends_in_cells`.
    """
    reader = spark.read.schema(schema).options(
        header="true", sep=sep, multiLine=str(line_ends_in_cells).lower(), quote='"', escape='"', nullValue="\\N", emptyValue=""
    )
    return reader.csv(path).drop(*drop)


def rows_from_csv_text(df: DataFrame, payload: str, schema: str, header: bool = False) -> DataFrame:
    """CSV held in a text column to typed rows; the other columns are repeated."""
    lines = F.filter(F.split(payload, r"\r?\n"), lambda x: F.trim(x) != "")
    if header:
        lines = F.slice(lines, 2, F.greatest(F.size(lines) - 1, F.lit(0)))
    others = [c for c in df.columns if c != payload]
    parsed = df.select(*others, F.explode(lines).alias("_line"))
    return parsed.select(*others, F.from_csv("_line", schema).alias("_row")).select(*others, "_row.*")


def file_inventory(
    spark: SparkSession, folder: str, name_glob: str = "*", recursive: bool = True, ignore: tuple[str, ...] = ()
) -> DataFrame:
    """Files with size and modification time; the contents are not read."""
    files = (
        spark.read.format("binaryFile")
        .option("pathGlobFilter", name_glob)
        .option("recursiveFileLookup", str(recursive).lower())
        .load(folder)
        .select(F.element_at(F.split("path", "/"), -1).alias("file_name"), "length", "modificationTime", "path")
    )
    return files.where(~F.col("file_name").isin(*ignore)) if ignore else files


def whole_texts(spark: SparkSession, folder: str, name_glob: str = "*.txt", separator: str | None = None) -> DataFrame:
    """One row per file or, with a separator behind each of them, per document of a file. The last line end of a whole file is the writer's.

    With a separator a file is read document by document, by several tasks where it is large.
    """
    reader = spark.read.option("pathGlobFilter", name_glob)
    file_name = F.col("_metadata.file_name").alias("file_name")
    if separator is not None:
        return reader.option("lineSep", separator).text(folder).select(F.col("value").alias("text"), file_name)
    texts = reader.text(folder, wholetext=True)
    return texts.select(F.regexp_replace("value", r"\n\z", "").alias("text"), file_name)


def json_documents(spark: SparkSession, folder: str, schema: str, name_glob: str = "*.json") -> DataFrame:
    """One document, or an array of documents, per file."""
    return spark.read.schema(schema).option("multiLine", "true").option("pathGlobFilter", name_glob).json(folder)


def channel_from_path(name: str = "stream") -> Column:
    """Channel label of a row, from the sub-folder its file lies in."""
    return F.regexp_extract(F.col("_metadata.file_path"), rf"/{name}=([^/]+)/", 1)


def preview(df: DataFrame, order: list[Column], n: int) -> DataFrame:
    return df.orderBy(*order).limit(n)
