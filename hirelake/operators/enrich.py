"""Batched row enrichment by a caller-supplied function (e.g. a model client).

Rows travel to Python as Arrow data; only the input columns become Python
values, all other columns pass through untouched.  A task cuts its rows, in
order and across Arrow batches, into groups of ``batch_size`` and hands each to
``fn``.  A group whose call fails, or whose reply has fewer lists than rows,
gets empty lists and ``enrich_failed`` set, and the job goes on.  Texts are
passed whole; ``fn`` decides what to send.
"""
from __future__ import annotations

import sys
from typing import Callable, Sequence

from pyspark import cloudpickle
from pyspark.errors import AnalysisException
from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import ArrayType, BooleanType, StringType, StructField, StructType

from hirelake.functions.vocab import ENRICH_BATCH

# Task code of this module is shipped by value: executors need no copy of the package.
cloudpickle.register_pickle_by_value(sys.modules[__name__])

LEDGER = "key binary, items array<string>"
EnrichFn = Callable[[Sequence[tuple]], Sequence]


def clean_items(items) -> list[str]:
    """The trimmed texts of a reply's items, without falsy and blank ones."""
    if not isinstance(items, (list, tuple)):
        return []
    return [s for s in (str(x).strip() for x in items if x) if s]


def enrich(df: DataFrame, fn: EnrichFn, batch_size: int = ENRICH_BATCH,
           inputs: Sequence[str] = ("job_title", "job_description"),
           out: str = "skills_enriched", failed: str = "enrich_failed") -> DataFrame:
    """All columns, the skill lists that ``fn`` found, and whether the row's group failed."""
    schema = StructType([*df.schema.fields, StructField(out, ArrayType(StringType())), StructField(failed, BooleanType())])
    arrow = to_arrow_schema(schema)
    size = max(1, int(batch_size))
    at = [df.columns.index(c) for c in inputs]

    def reply(rows):
        try:
            got = list(fn(rows))
            if len(got) < len(rows):
                raise ValueError("short reply")
            return [clean_items(r) for r in got[:len(rows)]], False
        except Exception:  # noqa: BLE001 - a failed group is marked, and the job goes on
            return [[] for _ in rows], True

    def run(batches):
        import pyarrow as pa

        def answered(group):
            table = pa.Table.from_batches(group).combine_chunks()
            rows = list(zip(*[table.column(i).to_pylist() for i in at]))
            lists, bad = reply(rows)
            columns = [c if c.type.equals(f.type) else c.cast(f.type) for c, f in zip(table.columns, arrow)]
            columns += [pa.chunked_array([pa.array(lists, pa.list_(pa.string()))]).cast(arrow.field(len(columns)).type),
                        pa.chunked_array([pa.array([bad] * len(rows), pa.bool_())])]
            yield from pa.Table.from_arrays(columns, schema=arrow).to_batches()

        group, held = [], 0
        for batch in batches:
            start = 0
            while start < batch.num_rows:
                part = batch.slice(start, size - held)
                group.append(part)
                held += part.num_rows
                start += part.num_rows
                if held == size:
                    yield from answered(group)
                    group, held = [], 0
        if held:
            yield from answered(group)

    return df.mapInArrow(run, schema)


def title_terms_in_description(rows: Sequence[tuple]) -> list[list[str]]:
    """Small deterministic stand-in extractor: lowercased title words of three
    or more letters that also occur in the description, in title order."""
    out = []
    for title, desc in rows:
        d = (desc or "").lower()
        words = (w.strip(".,;:!?()[]{}\"'") for w in (title or "").lower().split())
        out.append(list(dict.fromkeys(w for w in words if len(w) >= 3 and w in d)))
    return out


def content_key(inputs: Sequence[str]) -> Column:
    """256-bit digest of the inputs' values (nulls differ from every text)."""
    return F.unhex(F.sha2(F.to_json(F.struct(*[F.col(c).alias(f"c{i}") for i, c in enumerate(inputs)]), {"ignoreNullFields": "false"}), 256))


def read_ledger(spark, ledger: str) -> DataFrame:
    """(key, items) of the calls that succeeded; of a key that was answered twice, one row."""
    try:
        rows = spark.read.schema(LEDGER).parquet(ledger)
    except AnalysisException as e:
        if e.getCondition() != "PATH_NOT_FOUND":
            raise
        rows = spark.createDataFrame([], LEDGER)
    return rows.groupBy("key").agg(F.min("items").alias("items"))


def enrich_once(df: DataFrame, fn: EnrichFn, ledger: str, batch_size: int = ENRICH_BATCH,
                inputs: Sequence[str] = ("job_title", "job_description"),
                out: str = "skills_enriched", failed: str = "enrich_failed", rounds: int = 1) -> DataFrame:
    """:func:`enrich`, with one call for each distinct input and a ledger of the answers.

    ``ledger`` is a folder of Parquet rows (input digest, answer) that grows
    with every run.  Only inputs that it does not hold are sent, each once
    however many rows have it; failed groups are not recorded, so the next run
    sends them again.  The new inputs go in ``rounds`` jobs, by a part of their
    digest, and each job's answers are in the ledger when it ends: what a lost
    executor can make the job send again is what that executor was sending, and
    what a killed run leaves to its rerun is less than one round.
    """
    key, spark = "_enrich_key", df.sparkSession
    keyed = df.withColumn(key, content_key(inputs))
    for k in range(max(1, rounds)):
        mine = keyed.where(F.pmod(F.xxhash64(key), F.lit(max(1, rounds))) == k)
        new = (mine.select(key, *inputs).dropDuplicates([key]).join(read_ledger(spark, ledger), F.col(key) == F.col("key"), "left_anti"))
        answers = enrich(new, fn, batch_size, inputs, "items", "bad")
        answers.where(~F.col("bad")).select(F.col(key).alias("key"), "items").write.mode("append").parquet(ledger)
    got = read_ledger(spark, ledger)
    joined = keyed.join(got, F.col(key) == F.col("key"), "left")
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], F.coalesce("items", F.array().cast("array<string>")).alias(out), F.col("key").isNull().alias(failed))
