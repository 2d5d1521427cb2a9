"""CSV in and out, and the row number that fixes the order of rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

#: Cells that stand for a missing value; fixed values.
NA_TOKENS = ("", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null")
NUMBERS = ("latitude", "longitude")
#: Types that columns may have, the narrowest first, and what all their cells look like.
TYPES = (("bigint", r"^-?(0|[1-9]\d{0,17})$"), ("double", r"^-?(0|[1-9]\d*)(\.\d+)?([eE][+-]?\d+)?$"), ("boolean", r"^(true|false)$"))
BOM = b"\xef\xbb\xbf"


def with_row_id(df: DataFrame) -> DataFrame:
    """df with row_id, ascending in the order of the scan; to be called right after reading."""
    return df if "row_id" in df.columns else df.withColumn("row_id", F.monotonically_increasing_id())


def read_csv(spark: SparkSession, path: str, numbers: Sequence[str] = NUMBERS, infer: bool = False, line_breaks: bool = True) -> DataFrame:
    """A CSV file or folder with header: strings, numbers as doubles, missing cells as nulls, and row_id.

    infer: other columns get the narrowest of long, double, boolean and string that holds all
    their cells, by one more look at the file. line_breaks: cells may have line breaks; without
    them a file is split among tasks.
    """
    raw = spark.read.csv(path, header=True, multiLine=line_breaks, escape='"', encoding="UTF-8", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)

    def cell(c: str):
        kept = F.when(~F.col(f"`{c}`").isin(*NA_TOKENS), F.col(f"`{c}`"))
        return (kept.try_cast("double") if c in numbers else kept).alias(c)

    df = raw.select(*[cell(c) for c in raw.columns])
    return with_row_id(inferred(df) if infer else df)


def inferred(df: DataFrame) -> DataFrame:
    """df, its string columns cast to the narrowest of TYPES that holds all their cells; one without cells stays."""
    texts = [c for c, kind in df.dtypes if kind == "string"]
    fits = [F.bool_and(F.col(f"`{c}`").isNull() | F.col(f"`{c}`").rlike(pattern)).alias(f"{i}-{kind}") for i, c in enumerate(texts) for kind, pattern in TYPES]
    found = df.agg(*fits, *[F.count(f"`{c}`").alias(f"{i}-n") for i, c in enumerate(texts)]).first() if texts else {}
    kinds = {c: next((kind for kind, _ in TYPES if found[f"{i}-n"] and found[f"{i}-{kind}"]), "string") for i, c in enumerate(texts)}
    return df.select(*[F.col(f"`{c}`").cast(kinds.get(c, kind)).alias(c) for c, kind in df.dtypes])


def write_csv(df: DataFrame, path: str, order: str | None = "row_id", single: bool = True) -> str:
    """One CSV file with byte order mark and header, rows in order, without the order column.

    Spark sorts and writes the parts; they are put together by the Hadoop file system, part by
    part, on the driver. single=False leaves them as a folder of files in order, each with a
    header, and nothing goes through the driver.
    """
    spark = df.sparkSession
    ordered = df.orderBy(order).drop(order) if order and order in df.columns else df
    if not single:
        ordered.write.mode("overwrite").csv(path, header=True, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
        return path
    parts = f"{path}.parts"
    ordered.write.mode("overwrite").csv(parts, escape='"', emptyValue="", ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False)
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    source, target = jvm.org.apache.hadoop.fs.Path(parts), jvm.org.apache.hadoop.fs.Path(path)
    fs = source.getFileSystem(conf)
    out = fs.create(target, True)
    try:
        header = ",".join('"' + c.replace('"', '""') + '"' if any(x in c for x in ',"\n') else c for c in ordered.columns)
        out.write(bytearray(BOM + header.encode() + b"\n"))
        for part in sorted(s.getPath().toString() for s in fs.listStatus(source) if s.getPath().getName().startswith("part-")):
            opened = fs.open(jvm.org.apache.hadoop.fs.Path(part))
            try:
                jvm.org.apache.hadoop.io.IOUtils.copyBytes(opened, out, 1 << 16, False)
            finally:
                opened.close()
    finally:
        out.close()
    fs.delete(source, True)
    return path
