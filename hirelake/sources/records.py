"""Records of CSV files with quoted line breaks, found in parallel.

A line break ends a record unless a quoted field is open there, and whether one
is open depends on everything before it.  Every line maps the two possible
states at its start to the state at its end; these maps compose.  Pass one gives
the map of each split of a file (one row a split), the states at the splits'
starts follow, and pass two joins the lines of each split to records.  A record
that crosses into other splits is put together from its parts afterwards.
"""
from __future__ import annotations

import re

import numpy as np
from pyspark.sql import DataFrame, SparkSession, Window, functions as F

from hirelake.session import scratch_path

#: A quoted field from its opening quote to the next delimiter; doubled quotes are text.
QUOTED = re.compile(r'(^|,)"[^"]*(?:""[^"]*)*"(?!")[^,]*')
REST_OF_QUOTED = re.compile(r'[^"]*(?:""[^"]*)*"(?!")[^,]*')
OPENING = re.compile(r'(?:^|,)"')

COMPLETE, HEAD, TAIL, MIDDLE = 0, 1, 2, 3


def ends_open(line: str, opened: bool) -> bool:
    """Whether a quoted field is open at the end of a line, by whether one is at its start.

    A quote opens a field only as its first character, so a quote inside an
    unquoted field is text.
    """
    if opened:
        closed = REST_OF_QUOTED.match(line)
        if not closed:
            return True
        line = line[closed.end():]
    return OPENING.search(QUOTED.sub(r"\1", line)) is not None


def line_maps(values) -> tuple[np.ndarray, np.ndarray]:
    """For every line, the state (1: open) at its end if its start is not open, and if it is."""
    import pyarrow.compute as pc
    shut, opened = np.zeros(len(values), np.int8), np.ones(len(values), np.int8)
    for i in np.flatnonzero(np.asarray(pc.match_substring(values, '"'))).tolist():
        line = values[i].as_py()
        shut[i], opened[i] = ends_open(line, False), ends_open(line, True)
    return shut, opened


def states(shut: np.ndarray, opened: np.ndarray, start: int) -> np.ndarray:
    """The state after every line, from the state before the first one."""
    flips = np.cumsum((shut == 1) & (opened == 0))
    fixed = np.maximum.accumulate(np.where(shut == opened, np.arange(len(shut)), -1))
    known = fixed >= 0
    base, before = np.where(known, shut[fixed], start), np.where(known, flips[fixed], 0)
    return base ^ ((flips - before) & 1)


def _lines(spark: SparkSession, path: str) -> DataFrame:
    """The lines, each with (a 64-bit name of) its file and the start of the split that holds its beginning."""
    reader = spark.read.option("lineSep", "\n").option("recursiveFileLookup", True)
    return reader.text(path).select(F.xxhash64("_metadata.file_path").alias("file"),
                                    F.col("_metadata.file_block_start").alias("at"), "value")


def _runs(batch):
    """(file, split start, lines) of the stretches of a batch that lie in one split."""
    file, at = (batch.column(i).to_numpy(zero_copy_only=False) for i in (0, 1))
    new = np.flatnonzero((np.diff(file) != 0) | (np.diff(at) != 0)) + 1
    for a, b in zip([0, *new.tolist()], [*new.tolist(), batch.num_rows]):
        if a < b:
            yield int(file[a]), int(at[a]), batch.column(2).slice(a, b - a)


def split_starts(lines: DataFrame) -> dict[tuple[int, int], int]:
    """The state at the start of every split: two bits and two numbers a split reach the driver."""
    def run(batches):
        import pyarrow as pa

        here, ends = None, [0, 1]
        for batch in batches:
            for file, at, values in _runs(batch):
                if here is not None and here != (file, at):
                    yield pa.RecordBatch.from_pylist([dict(file=here[0], at=here[1], shut=ends[0], opened=ends[1])], schema=out)
                if here != (file, at):
                    here, ends = (file, at), [0, 1]
                shut, opened = line_maps(values)
                ends = [int(states(shut, opened, e)[-1]) for e in ends]
        if here is not None:
            yield pa.RecordBatch.from_pylist([dict(file=here[0], at=here[1], shut=ends[0], opened=ends[1])], schema=out)

    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    ddl = "file bigint, at bigint, shut int, opened int"
    out = to_arrow_schema(StructType.fromDDL(ddl))
    starts, file, state = {}, None, 0
    for r in sorted(lines.mapInArrow(run, ddl).collect()):
        state = 0 if r.file != file else state
        starts[r.file, r.at], file = state, r.file
        state = r.opened if state else r.shut
    return starts


def csv_records(spark: SparkSession, path: str) -> DataFrame:
    """(header, record): every record of the CSV files under ``path`` as its text, without the line break behind it.

    ``header`` marks the first record of each file.  Lines end in LF or CR LF;
    a quoted field that is never closed runs to the end of its file.  The
    records are written once to the shared scratch folder.
    """
    lines = _lines(spark, path)
    starts = spark.sparkContext.broadcast(split_starts(lines))
    ddl = "file bigint, at bigint, kind tinyint, header boolean, record string"
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    out = to_arrow_schema(StructType.fromDDL(ddl))

    def run(batches):
        import pyarrow as pa
        import pyarrow.compute as pc

        def rows(file, at, kind, header, records):
            n = len(records)
            first = np.zeros(n, bool)
            first[:1] = header
            return pa.RecordBatch.from_arrays([pa.array(np.full(n, file)), pa.array(np.full(n, at)), pa.array(np.full(n, kind, np.int8)),
                                               pa.array(first), records.cast(pa.string())], schema=out)

        here, state, held, begun, first = None, 0, [], False, False

        def rest():
            """What is left of a split is the start of a record, or lies wholly inside one."""
            if held:
                yield rows(*here, TAIL if begun else MIDDLE, first and begun, pc.binary_join(pa.array([held], pa.list_(pa.string())), "\n"))

        for batch in batches:
            for file, at, values in _runs(batch):
                if here != (file, at):
                    if here is not None:
                        yield from rest()
                    here, state, held = (file, at), starts.value[file, at], []
                    begun, first = not state, at == 0  # begun: the lines held start a record
                after = states(*line_maps(values), state)
                ends = np.flatnonzero(after == 0)
                if len(ends):
                    stops = np.append(0, ends + 1).astype(np.int32)
                    texts = pc.binary_join(pa.ListArray.from_arrays(pa.array(stops), pa.concat_arrays([values]).cast(pa.string())), "\n")
                    if held:
                        texts = pa.concat_arrays([pa.array(["\n".join([*held, texts[0].as_py()])], pa.string()), texts.slice(1)])
                    if not begun:
                        yield rows(file, at, HEAD, False, texts.slice(0, 1))
                        texts = texts.slice(1)
                    if len(texts):
                        yield rows(file, at, COMPLETE, first, texts)
                        first = False
                    begun, held = True, []
                held += values.slice(int(ends[-1]) + 1 if len(ends) else 0).to_pylist()
                state = int(after[-1])
        if here is not None:
            yield from rest()

    target = scratch_path(spark, "csv_records")
    lines.mapInArrow(run, ddl).write.parquet(target)
    pieces = spark.read.schema(ddl).parquet(target)
    order = Window.partitionBy("file").orderBy("at", "kind")
    parts = pieces.where(F.col("kind") != COMPLETE).withColumn("number", F.count_if(F.col("kind") == TAIL).over(order))
    joined = (parts.groupBy("file", "number").agg(F.sort_array(F.collect_list(F.struct("at", "kind", "record"))).alias("parts"), F.bool_or("header").alias("header"))
              .select("header", F.array_join(F.col("parts.record"), "\n").alias("record")))
    text = F.when(F.col("record").endswith("\r"), F.expr("left(record, length(record) - 1)")).otherwise(F.col("record"))
    return pieces.where(F.col("kind") == COMPLETE).select("header", "record").unionByName(joined).select("header", text.alias("record"))
