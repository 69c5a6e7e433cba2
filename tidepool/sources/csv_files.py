"""Delimited text in and out, all values as strings."""

from __future__ import annotations

import csv
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tidepool.storage import materialize, sized_join


def read_csv(spark: SparkSession, path: str, columns: Sequence[str] | None = None,
             separator: str = ",", multi_line: bool = True) -> DataFrame:
    """Header names the columns, quotes are doubled, cells are trimmed, blank lines skipped.

    ``multi_line`` allows line breaks inside quotes: :func:`records` then finds the records, with many
    tasks for one file.
    """
    options = dict(sep=separator, quote='"', escape='"', ignoreLeadingWhiteSpace=True,
                   ignoreTrailingWhiteSpace=True, emptyValue="")
    if multi_line:
        found = materialize(records(spark, path), "records")
        if columns is None:
            header = found.filter("record = 1").orderBy("file").first()
            if header is None:
                raise ValueError(f"no header below {path}")
            columns = [c.strip() for c in next(csv.reader([header["text"]], delimiter=separator))]
        schema = T.StructType([T.StructField(c, T.StringType()) for c in columns])
        parsed = F.from_csv("text", _ddl(schema), {k: str(v).lower() if isinstance(v, bool) else v
                                                   for k, v in options.items()})
        rows = found.filter("record > 1").select(parsed.alias("_row")).select("_row.*")
    else:
        reader = spark.read.options(header=True, inferSchema=False, **options)
        if columns is not None:
            reader = reader.schema(T.StructType([T.StructField(c, T.StringType()) for c in columns]))
        rows = reader.csv(path)
    return rows.select(*[F.regexp_replace(F.coalesce(F.col(f"`{c}`"), F.lit("")), r"^\s+|\s+$", "").alias(c)
                         for c in rows.columns])


def _ddl(schema: T.StructType) -> str:
    return ", ".join(f"`{f.name}` STRING" for f in schema.fields)


def records(spark: SparkSession, path: str) -> DataFrame:
    """(file, record, text): the records of quoted text files, numbered from 1 within each file.

    A line break belongs to a cell if an odd number of quotes comes before it.  Every split of a file
    counts its quotes by itself; the sums of the splits before it, of which a file has few, say
    whether it begins inside a cell.  A line that is a record of its own is done then, and only the
    lines of longer records are put together, across splits as well.  Blank lines between records are
    none.  Quotes may stand only round cells and, doubled, in them; after one that is never closed the
    rest of a file is one record.
    """
    quotes = F.length("value") - F.length(F.replace("value", F.lit('"'), F.lit("")))
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.monotonically_increasing_id().alias("line"), "value", quotes.alias("quotes"))
    lines = materialize(lines, "lines")

    # a split is at most as long as spark.sql.files.maxPartitionBytes, so a window holds one
    inside = Window.partitionBy("file", "split").orderBy("line")
    splits_before = Window.partitionBy("file").orderBy("split").rowsBetween(
        Window.unboundedPreceding, -1)
    before = Window.partitionBy("file", "split").orderBy("line").rowsBetween(
        Window.unboundedPreceding, -1)
    entered = lines.groupBy("file", "split").agg(F.sum("quotes").alias("n")).select(
        "file", "split", F.coalesce(F.sum("n").over(splits_before), F.lit(0)).alias("entered"))
    open_ = (F.col("entered") + F.coalesce(F.sum("quotes").over(before), F.lit(0))) % 2 == 1
    placed = sized_join(lines, entered, ["file", "split"], spread="line").withColumn("open", open_)
    placed = placed.filter(F.col("open") | F.col("value").rlike(r"\S"))
    placed = placed.withColumn("starts", F.when(F.col("open"), 0).otherwise(1))
    placed = materialize(placed.withColumn("own", F.sum("starts").over(inside)), "placed")
    earlier = placed.groupBy("file", "split").agg(F.sum("starts").alias("n")).select(
        "file", "split", F.coalesce(F.sum("n").over(splits_before), F.lit(0)).alias("earlier"))
    numbered = sized_join(placed, earlier, ["file", "split"], spread="line").select(
        "file", "split", "line", "value", (F.col("earlier") + F.col("own")).alias("record"),
        (~F.col("open") & (F.col("quotes") % 2 == 0)).alias("whole"))
    parts = F.array_sort(F.collect_list(F.struct("split", "line", "value")))
    longer = numbered.filter("NOT whole").groupBy("file", "record").agg(
        F.array_join(F.transform(parts, lambda p: p["value"]), "\n").alias("text"))
    return numbered.filter("whole").select("file", "record", F.col("value").alias("text")).unionByName(
        longer)


def write_csv(df: DataFrame, path: str, separator: str = ",") -> None:
    """Null becomes empty; cells holding the separator, a quote or white space are quoted."""
    cells = []
    for c in df.columns:
        text = F.coalesce(F.col(c).cast("string"), F.lit(""))
        doubled = F.replace(text, F.lit('"'), F.lit('""'))
        quoted = F.concat(F.lit('"'), doubled, F.lit('"'))
        needs = text.contains(separator) | text.rlike('[" \\t\\r\\n]')
        cells.append(F.when(needs, quoted).otherwise(text))
    header = separator.join(df.columns)
    # The text writer has no header, so each file starts with one made in its own partition.
    rows = df.select(F.concat_ws(separator, *cells).alias("value"),
                     F.monotonically_increasing_id().alias("_i"))
    first = F.col("_i").bitwiseAND((1 << 33) - 1) == 0
    rows.select(F.when(first, F.concat(F.lit(header + "\n"), "value")).otherwise(
        F.col("value")).alias("value")).write.text(path)
