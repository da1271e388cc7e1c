"""Raw CSV batches: read one or many dated files, and pick which dates to load.

File names are ``dd-MM-yyyy.csv``.  Discovery is a DataFrame over file names
(from a listing of the input folder, or any column of names), so the same
rule runs on a handful of names or on millions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from roadlake.operators.bronze import sanitize_columns, stamp_date, union_batches

# The batch file-name pattern and the shortest accepted name.
NAME_PATTERN = r"^(\d{2}-\d{2}-\d{4})\.csv$"
PATH_PATTERN = r".*/(\d{2}-\d{2}-\d{4})\.csv(?:/[^/]*)?$"
#: A batch is a file ``x.csv``, or the parts directly in a folder ``x.csv``.
BATCH_PATTERN = r"^(.*?/([^/]+\.csv))(?:/[^/]+\.csv)?$"
DATE_FORMAT = "dd-MM-yyyy"
MIN_NAME_LENGTH = 14


def csv_reader(spark: SparkSession, columns: Sequence[str] | None = None, multi_line: bool = True):
    """Header on, quotes escaped by doubling; every column read as text.

    With ``columns`` the schema is fixed up front (no header-inference job).
    Each file's header is checked against the schema, so files whose columns
    differ fail instead of being read by position.  ``multi_line`` accepts
    line breaks inside quoted cells but makes every file one unsplittable task;
    a large daily batch is best kept as a folder of parts, read in parallel.
    Without it one large file is read by many tasks; ``refuse_line_breaks``
    first makes sure that no row would be cut in two.
    """
    reader = (spark.read.option("header", "true").option("escape", '"')
              .option("enforceSchema", "false").option("multiLine", str(multi_line).lower()))
    if columns is not None:
        reader = reader.schema(T.StructType([T.StructField(n, T.StringType()) for n in columns]))
    return reader


def refuse_line_breaks(spark: SparkSession, path: str | Sequence[str]) -> None:
    """Raise if a quoted cell holds a line break: its first line then has an odd number of quotes."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    cut = spark.read.text(path).filter(quotes % 2 == 1).select("value").head(1)
    if cut:
        raise ValueError(f"a cell of {path} holds a line break ({cut[0].value[:80]!r}); read it with multi_line")


def read_csv_batch(spark: SparkSession, path: str | Sequence[str], columns: Sequence[str] | None = None,
                   with_file_date: bool = False, multi_line: bool = True) -> DataFrame:
    """Read CSV batch file(s) or batch folder(s) with clean column names.

    ``with_file_date`` adds ``situation_date`` parsed from each row's batch
    name in its path, so several daily batches with the same header are read
    in one scan.
    """
    if not multi_line:
        refuse_line_breaks(spark, path)
    df = csv_reader(spark, columns, multi_line).csv(path)
    if with_file_date:
        df = df.withColumn("situation_date", path_date(F.col("_metadata.file_path")))
    return sanitize_columns(df)


def read_dated_batches(spark: SparkSession, files: Sequence[tuple[str, object]],
                       multi_line: bool = True) -> DataFrame:
    """Read each (path, day) file, stamp its day, and union the batches by column name.

    Files may list their columns in different orders; a file with a
    different set of columns fails the union.
    """
    parts = [stamp_date(read_csv_batch(spark, path, multi_line=multi_line), day) for path, day in files]
    return union_batches(parts)


def file_date(name: Column) -> Column:
    """``dd-MM-yyyy.csv`` -> date; NULL for any other name."""
    text = F.regexp_extract(name, NAME_PATTERN, 1)
    return F.when(text != "", F.try_to_timestamp(text, F.lit(DATE_FORMAT)).cast("date"))


def path_date(path: Column) -> Column:
    """Date of the batch a file belongs to: the last ``dd-MM-yyyy.csv`` segment of its path."""
    text = F.regexp_extract(path, PATH_PATTERN, 1)
    return F.when(text != "", F.try_to_timestamp(text, F.lit(DATE_FORMAT)).cast("date"))


def list_csv_files(spark: SparkSession, folder: str) -> DataFrame:
    """Batch names under a folder: each ``*.csv`` file, or each folder of ``*.csv`` parts.

    A daily batch may be one file (``01-01-2025.csv``) or, at scale, a folder
    of part files (``01-01-2025.csv/part-*.csv``).  Columns: ``file_name`` and
    ``path``, the batch's full address however ``folder`` was typed.  File
    contents are not read.
    """
    listing = (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
               .option("recursiveFileLookup", "true").load(folder).select("path"))
    part = lambda n: F.regexp_extract("path", BATCH_PATTERN, n)
    return listing.select(part(2).alias("file_name"), part(1).alias("path")).distinct()


def select_batches(names: DataFrame, year: int, month: int, limit: int = 3,
                   name_col: str = "file_name") -> DataFrame:
    """Dated batch files of one month, earliest first, the first ``limit`` of them.

    Output: ``file_name``, ``situation_date``, ``batch`` (0-based), and
    ``path`` if the names come with it.  ``limit``
    is the feature (how many daily batches a run loads); the result has at
    most 31 rows, so the final ordering window is bounded.
    """
    name = F.col(name_col)
    day = file_date(name)
    path = [F.col("path")] if "path" in names.columns else []
    picked = (names.select(name.alias("file_name"), *path, day.alias("situation_date"))
              .filter((F.length("file_name") >= MIN_NAME_LENGTH)
                      & F.col("situation_date").isNotNull()
                      & (F.year("situation_date") == year) & (F.month("situation_date") == month))
              .distinct()
              .orderBy("situation_date", "file_name").limit(limit))
    order = Window.orderBy("situation_date", "file_name")
    return picked.withColumn("batch", (F.row_number().over(order) - 1).cast("int"))


def batch_file_names(events: DataFrame, ts_col: str = "ts") -> DataFrame:
    """File names a daily export of a timestamped feed would produce."""
    return events.select(F.concat(F.date_format(F.col(ts_col), DATE_FORMAT), F.lit(".csv")).alias("file_name"))


def with_file_order(df: DataFrame) -> tuple[DataFrame, list[str]]:
    """A file scan with columns that order its rows as they stand in the files, and their names.

    Row numbers grow along each block of a file; blocks are told apart by
    where they start.
    """
    order = {"_file": F.col("_metadata.file_path"), "_block": F.col("_metadata.file_block_start"),
             "_row": F.monotonically_increasing_id()}
    return df.withColumns(order), list(order)


def write_daily_batches(batches: DataFrame, folder: str, date_col: str = "situation_date",
                        drop: Sequence[str] = ("batch",)) -> list[str]:
    """Write each batch day as a folder of CSV parts named ``dd-MM-yyyy.csv``.

    The split output is checkpointed, so each day is a filtered re-read of it;
    there are as many writes as batch days (a handful), and every write is
    parallel over the day's rows.  Headers on, quotes escaped by doubling.
    """
    days = [r[0] for r in batches.select(date_col).distinct().orderBy(date_col).collect()]  # one row per day
    paths = []
    for day in days:
        path = f"{folder.rstrip('/')}/{day:%d-%m-%Y}.csv"
        (batches.filter(F.col(date_col) == F.lit(day)).drop(date_col, *drop)
         .write.mode("overwrite").option("header", "true").option("escape", '"').csv(path))
        paths.append(path)
    return paths
