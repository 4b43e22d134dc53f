"""Scans of the source files: CSV with a header, Parquet rows, input picking."""
from __future__ import annotations

import csv
import io

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession, functions as F

from hirelake.functions.vocab import CSV_NA_VALUES
from hirelake.sources.records import csv_records


def pandas_style_headers(names: list[str]) -> list[str]:
    """Repeated header names get '.1', '.2', ... suffixes (as pandas does),
    so exact-name column maps written for such files still apply."""
    seen: dict[str, int] = {}
    taken = set(names)
    out = []
    for n in names:
        n = "" if n is None else str(n)
        if n in seen:
            k = seen[n]
            cand = f"{n}.{k}"
            while cand in taken:
                k += 1
                cand = f"{n}.{k}"
            seen[n] = k + 1
            taken.add(cand)
            out.append(cand)
        else:
            seen[n] = 1
            out.append(n)
    return out


def read_csv_source(spark: SparkSession, path: str, na_values=CSV_NA_VALUES,
                    min_partitions: int | None = None) -> DataFrame:
    """All columns as text, quoted multi-line fields allowed, the usual
    missing-value spellings turned into NULL, repeated headers de-duplicated.

    Files are cut into records in parallel (see ``sources.records``), so one
    large file is as many tasks as it has splits; its records are parsed by
    Spark.  Files under a folder are read by position and must share one
    header.  Blank lines are skipped.  ``min_partitions`` spreads the rows of
    inputs with fewer splits (round robin, no key).
    """
    records = csv_records(spark, path)
    headers = [r.record for r in records.where("header").select("record").distinct().limit(2).collect()]
    if len(headers) > 1:
        raise ValueError(f"the CSV files under {path} have different headers: read them one at a time")
    if not headers:
        return spark.createDataFrame([], "value string").drop("value")
    names = pandas_style_headers(next(csv.reader(io.StringIO(headers[0].lstrip("\ufeff"), newline=""))))
    fields = ", ".join(f"c{i} string" for i in range(len(names)))
    rows = records.where("not header and trim(record) != ''").select(
        F.from_csv("record", fields, {"escape": '"', "mode": "PERMISSIVE", "maxCharsPerColumn": "-1"}).alias("r"))
    na = list(na_values)
    value = [F.col(f"r.c{i}") for i in range(len(names))]
    df = rows.select(*[F.when(v.isin(na), F.lit(None)).otherwise(v).alias(n) for n, v in zip(names, value)])
    if min_partitions:
        df = df.repartition(int(min_partitions))
    return df


def read_parquet_source(spark: SparkSession, path: str) -> DataFrame:
    return spark.read.option("recursiveFileLookup", True).parquet(path)


def list_csv_files(spark: SparkSession, directory: str) -> DataFrame:
    """(path, length) of every CSV under a directory; contents are not read."""
    return (spark.read.format("binaryFile").option("pathGlobFilter", "*.csv")
            .option("recursiveFileLookup", True).load(directory).select("path", "length"))


def pick_input_file(spark: SparkSession, directory: str, how: str = "largest") -> str:
    """The largest CSV (``how='largest'``) or the first by path (``'first'``)
    under a directory.  No CSV at all is an error."""
    order = [F.col("length").desc(), F.col("path")] if how == "largest" else [F.col("path")]
    try:
        row = list_csv_files(spark, directory).orderBy(*order).select("path").first()
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        row = None
    if row is None:
        raise FileNotFoundError(f"no CSV found under {directory}")
    return row.path
