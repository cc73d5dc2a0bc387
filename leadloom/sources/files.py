"""Readers and writers of lists at rest: CSV of strings, JSON lines, split outputs, numbered batches."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F, types as T


def read_csv(spark: SparkSession, path: str | list[str], *, order: bool = False) -> DataFrame:
    """A quoted CSV with a header as text columns: nothing is inferred, blanks are empty strings, a byte mark is dropped.

    With ``order``, _file and _ord (from the file's place in the reading order) make "first wins" repeatable: a file of
    records with line breaks is read by one task, and its rows are numbered in their order.
    """
    df = spark.read.csv(path, header=True, multiLine=True, quote='"', escape='"', inferSchema=False)
    source = F.col("_metadata.file_path")
    extra = [source.alias("_file"), F.monotonically_increasing_id().alias("_ord")] if order else []
    return df.select(*[F.coalesce(F.col(f"`{c}`"), F.lit("")).alias(c.lstrip("\ufeff")) for c in df.columns], *extra)


def read_json_lines(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """JSON lines of a given schema; lines that do not parse are skipped."""
    return spark.read.schema(schema).json(path, mode="DROPMALFORMED")


def read_json_documents(spark: SparkSession, path: str | list[str], schema: T.StructType | str) -> DataFrame:
    """JSON documents (an object or an array of objects each), one row for each object."""
    return spark.read.schema(schema).json(path, multiLine=True)


def last_by_key(df: DataFrame, key: str, order: str) -> DataFrame:
    """The last record of each key, as an append-only checkpoint means it."""
    return df.groupBy(key).agg(F.max(F.struct(order, *[c for c in df.columns if c not in (key, order)])).alias("m")).select(key, "m.*")


def with_aliases(df: DataFrame, aliases: dict[str, list[str]]) -> DataFrame:
    """Columns by their first known alias (in any case); a column without one is blank."""
    known = {c.lower(): c for c in reversed(df.columns)}
    picks = [next((F.col(f"`{known[a.lower()]}`") for a in names if a.lower() in known), F.lit("")).alias(out) for out, names in aliases.items()]
    return df.select(*picks)


def newest_capture(df: DataFrame, row_id: str, name: str, address: str, captured: str, order: str) -> DataFrame:
    """For each id, or lower-case name|address where it is blank, the row captured last; ``order`` decides between equal times.

    The result has the key first and every column of the row.
    """
    given = F.trim(F.coalesce(F.col(row_id).cast("string"), F.lit("")))
    key = F.when(given != "", given).otherwise(F.lower(F.concat(F.coalesce(F.col(name).cast("string"), F.lit("")), F.lit("|"), F.coalesce(F.col(address).cast("string"), F.lit("")))))
    last = F.max_by(F.struct(*df.columns), F.struct(F.coalesce(F.col(captured).cast("string"), F.lit("")).alias("t"), F.col(order).alias("o")))
    return df.groupBy(key.alias("capture_key")).agg(last.alias("m")).select("capture_key", "m.*")


def flags_to_tags(df: DataFrame, prefix: str, out: str) -> DataFrame:
    """Columns prefix* that hold 1 as a |-joined list of their names' rests."""
    flags = [c for c in df.columns if c.startswith(prefix)]
    found = F.array_compact(F.array(*[F.when(F.col(c) == "1", F.lit(c[len(prefix):])) for c in flags]))
    return df.withColumn(out, F.array_join(found, "|"))


def write_csv(df: DataFrame, path: str, *, quote_all: bool = False) -> None:
    df.write.mode("overwrite").csv(path, header=True, quote='"', escape='"', quoteAll=quote_all, emptyValue="", nullValue="")


def write_split(df: DataFrame, path: str, by: str) -> None:
    """One folder for each value of a column."""
    df.write.mode("overwrite").partitionBy(by).parquet(path)


def append_checkpoint(df: DataFrame, path: str) -> None:
    df.write.mode("append").json(path)


def _folder(spark: SparkSession, path: str):
    target = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return target, target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def versions(spark: SparkSession, path: str) -> list[int]:
    """Complete versions of a table in <path>/v<number>, ascending; those without their mark of success are not listed."""
    root, fs = _folder(spark, path)
    if not fs.exists(root):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(root)]
    return sorted(int(n[1:]) for n in names if n[:1] == "v" and n[1:].isdigit() and fs.exists(_folder(spark, f"{path}/{n}/_SUCCESS")[0]))


def rewrite(df: DataFrame, path: str) -> DataFrame:
    """Write a table's next version beside the last and read it back: readers see the old one or the new one, never half of it."""
    number = max(versions(df.sparkSession, path), default=-1) + 1
    df.write.mode("overwrite").parquet(f"{path}/v{number}")
    return latest(df.sparkSession, path)


def latest(spark: SparkSession, path: str) -> DataFrame:
    """The last complete version of a table that ``rewrite`` wrote."""
    return spark.read.parquet(f"{path}/v{versions(spark, path)[-1]}")
