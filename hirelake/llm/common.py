"""Helpers shared by the operators: scratch tables, table reading, keyed streams, text blocks."""
from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hirelake.session import scratch_path

#: Names of helper columns start with this, or with :func:`private` where they stand beside a caller's columns.
PRIVATE = "__llm_"


def private(df: DataFrame) -> str:
    """A beginning for helper columns' names that no column of ``df`` has."""
    prefix = PRIVATE
    while any(c.lower().startswith(prefix) for c in df.columns):
        prefix += "_"
    return prefix


def read(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{table}.parquet")


def written(df: DataFrame, name: str) -> DataFrame:
    """Write an intermediate to the shared checkpoint folder and read it back.

    This cuts the lineage (a lost executor re-reads files) and fixes anything
    that could differ between two evaluations, such as partition numbers.
    """
    path = scratch_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


@contextmanager
def small_batches(spark: SparkSession, rows: int = 1000):
    """Jobs run inside hand Python at most ``rows`` rows at a time: a batch is held by the JVM and by the worker."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    before = int(spark.conf.get(key))
    spark.conf.set(key, min(before, rows) if before > 0 else rows)
    try:
        yield
    finally:
        spark.conf.set(key, before)


def text_bytes(col: str | Column = "text") -> Column:
    """The UTF-8 bytes of a text column; null counts as empty."""
    c = F.col(col) if isinstance(col, str) else col
    return F.coalesce(c.cast("binary"), F.lit(b""))


def crc_mod(doc_id: str | Column, n: int) -> Column:
    """crc32 of the id as text, modulo n (the folds of the contracts)."""
    c = F.col(doc_id) if isinstance(doc_id, str) else doc_id
    return F.crc32(c.cast("string").cast("binary")) % F.lit(n)


def keyed_stream(df: DataFrame, keys: list[str], order: list[str], fn, schema: str) -> DataFrame:
    """Rows of a key meet in one task, in ``order``, and ``fn`` reads them as a
    stream of Arrow batches: no group is ever held whole."""
    return df.repartition(*keys).sortWithinPartitions(*keys, *order).mapInArrow(fn, schema)


def fold_ascii(raw: bytes) -> bytes:
    """Lower-case A-Z only, as ``bytes.lower`` does."""
    return raw.lower()


def arrow_schema(df_schema) -> object:
    from pyspark.sql.pandas.types import to_arrow_schema
    return to_arrow_schema(df_schema)


def append_scores(df: DataFrame, text_col: str, new_fields: str, make_scorer, keep: list[str] | None = None,
                  block_bytes: int = 8 << 20) -> DataFrame:
    """Every row of ``df`` (its columns, or those in ``keep``) with new columns
    computed from its whole text.

    ``make_scorer()`` runs once per task and returns a function from a list of
    texts (bytes) to a dict of column lists.  Other columns pass through as
    Arrow data, untouched; those with a new column's name are replaced.  Texts
    are handed over in blocks of at most ``block_bytes`` (a longer text is a
    block of its own).
    """
    from pyspark.sql.types import StructType
    added = StructType.fromDDL(new_fields)
    taken = {f.name.lower() for f in added.fields}
    cols = [c for c in (df.columns if keep is None else keep) if c.lower() not in taken]
    raw = private(df) + "raw"
    src = df.select(*[F.col(f"`{c}`") for c in cols], text_bytes(F.col(f"`{text_col}`")).alias(raw))
    base = df.select(*[F.col(f"`{c}`") for c in cols])
    schema = StructType(list(base.schema.fields) + list(added.fields))
    names = [f.name for f in added.fields]
    out = arrow_schema(schema)

    def run(batches):
        import pyarrow as pa

        score = None
        for batch in batches:
            if score is None:
                score = make_scorer()
            start = 0
            texts, size = [], 0
            column = batch.column(batch.num_columns - 1)
            rest = batch.select(range(batch.num_columns - 1))

            def flush(upto):
                got = score(texts)
                part = rest.slice(start, upto - start)
                arrays = [c if c.type.equals(out.field(i).type) else c.cast(out.field(i).type)
                          for i, c in enumerate(part.columns)]
                arrays += [pa.array(got[n], type=out.field(len(cols) + i).type) for i, n in enumerate(names)]
                return pa.RecordBatch.from_arrays(arrays, schema=out)

            for i in range(batch.num_rows):
                t = column[i].as_py()
                if texts and size + len(t) > block_bytes:
                    yield flush(i)
                    start, texts, size = i, [], 0
                texts.append(t)
                size += len(t)
            if texts:
                yield flush(batch.num_rows)

    return src.mapInArrow(run, schema)
