"""The parallel CSV scan against Python's csv module and Spark's one-task reader."""
import csv
import io
import os
import random

import numpy as np
import pytest

from hirelake.sources import records
from hirelake.sources.files import read_csv_source


@pytest.fixture()
def small_splits(spark):
    """Splits of a few hundred bytes, so that one small file is many tasks."""
    keep = {k: spark.conf.get(k) for k in ("spark.sql.files.maxPartitionBytes", "spark.sql.files.openCostInBytes")}
    yield lambda n: [spark.conf.set("spark.sql.files.maxPartitionBytes", str(n)), spark.conf.set("spark.sql.files.openCostInBytes", "1")]
    for k, v in keep.items():
        spark.conf.set(k, v)


def written(folder, name, text):
    path = os.path.join(folder, name)
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w", newline="", encoding="utf-8") as f:
        f.write(text)
    return path


def by_csv_module(text):
    """Rows of the file as the reader should give them: blank lines skipped, empty cells NULL."""
    rows = [r for r in csv.reader(io.StringIO(text, newline="")) if r and any(x.strip() for x in r)]
    return rows[0], sorted([tuple(x or None for x in r) for r in rows[1:]], key=str)


def table(seed, rows, end="\n", long=0):
    r = random.Random(seed)
    out = io.StringIO(newline="")
    w = csv.writer(out, lineterminator=end)
    w.writerow(["id", "title", "note, with comma", "last"])
    for i in range(rows):
        cell = lambda: "".join(r.choice(['a', 'é', ',', '"', '\n', '\r\n', ' ', 'word', 'x,"y', '""'][:10 if r.random() < 0.4 else 1]) for _ in range(r.randrange(0, 12)))
        w.writerow([i, "t" + cell(), cell() + ("z\n" * long if i % 50 == 7 else "") + "n", "v" + cell()])
    return out.getvalue()


@pytest.mark.parametrize("seed,end,long,size", [(1, "\n", 0, 200), (2, "\r\n", 0, 333), (3, "\n", 400, 150), (4, "\n", 0, 1 << 20)])
def test_rows_equal_the_csv_module(spark, tmpdir_path, small_splits, seed, end, long, size):
    text = table(seed, 300, end, long)
    path = written(tmpdir_path, "one.csv", text)
    small_splits(size)
    names, want = by_csv_module(text)
    splits = records._lines(spark, path).rdd.getNumPartitions()
    assert splits > 20 if size < 1000 else splits >= 1
    df = read_csv_source(spark, path, na_values=[""])
    assert df.columns == names
    assert sorted([tuple(r) for r in df.collect()], key=str) == want


def test_maps_of_lines_compose(spark):
    r = random.Random(9)
    for _ in range(200):
        text = "".join(r.choice(['a', ',', '"', '\n', '""', ',"', '",']) for _ in range(60))
        lines = text.split("\n")
        import pyarrow as pa
        for start in (0, 1):
            state, want = start, []
            for line in lines:
                state = int(records.ends_open(line, bool(state)))
                want.append(state)
            assert records.states(*records.line_maps(pa.array(lines)), start).tolist() == want


def test_quotes_inside_unquoted_fields_are_text(spark, tmpdir_path, small_splits):
    path = written(tmpdir_path, "q.csv", 'a,b\n5" disk,x\n3" tape,"q\nr"\n,"say ""hi"""\n\n"",z\n')
    small_splits(16)
    got = [tuple(r) for r in read_csv_source(spark, path).collect()]
    assert sorted(got, key=str) == sorted([('5" disk', "x"), ('3" tape', "q\nr"), (None, 'say "hi"'), (None, "z")], key=str)


def test_folders_and_odd_files(spark, tmpdir_path, small_splits):
    small_splits(64)
    written(tmpdir_path, "d/a.csv", 'x,z\n1,"two\nlines"\n')
    written(tmpdir_path, "d/sub/b.csv", 'x,y\n2,"open to the end\nof file')
    written(tmpdir_path, "d/empty.csv", "")
    with pytest.raises(ValueError):
        read_csv_source(spark, os.path.join(tmpdir_path, "d"))
    written(tmpdir_path, "d/a.csv", '\ufeffx,y\n1,"two\nlines"\n')
    got = sorted(tuple(r) for r in read_csv_source(spark, os.path.join(tmpdir_path, "d")).collect())
    assert got == [("1", "two\nlines"), ("2", "open to the end\nof file")]
    written(tmpdir_path, "n/none.csv", "")
    assert read_csv_source(spark, os.path.join(tmpdir_path, "n")).collect() == []
    wide = written(tmpdir_path, "w.csv", '"a\nb",a,a\n1,2\n1,2,3,4\n')
    df = read_csv_source(spark, wide)
    assert df.columns == ["a\nb", "a", "a.1"] and sorted(map(str, map(tuple, df.collect()))) == ["('1', '2', '3')", "('1', '2', None)"]


def test_states_of_an_empty_stretch():
    assert records.states(np.zeros(0, np.int8), np.zeros(0, np.int8), 1).tolist() == []
