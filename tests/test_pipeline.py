import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from conftest import canon_frame
from hirelake.plans import pipeline as P


def _specs(spark, fail=False):
    def good(s):
        return canon_frame(s, [dict(source_id="src_a", job_title="Data engineer", posted_date=dt.date(2024, 1, 2),
                                    skills='["SQL","SQL"]')])

    def bad(s):
        raise RuntimeError("source broke")
    return [P.SourceSpec("a", "ds_a", "raw_pipe_a", good),
            P.SourceSpec("b", "ds_b", "raw_pipe_b", bad if fail else good)]


def test_first_failure_stops_the_run(spark, tmpdir_path):
    with pytest.raises(RuntimeError):
        P.ingest(spark, _specs(spark, fail=True), tmpdir_path)
    assert os.path.isdir(os.path.join(tmpdir_path, "raw", "ds_a"))  # staged, not published
    assert not os.path.exists(os.path.join(tmpdir_path, "raw", "_published"))
    assert not os.path.exists(os.path.join(tmpdir_path, "raw", "ds_b"))


def test_run_batch_skip_models_and_marts(spark, tmpdir_path):
    root = os.path.join(tmpdir_path, "tables")
    assert P.run_batch(spark, _specs(spark), tmpdir_path, skip_models=True, table_root=root) is None
    assert spark.table("master_jobs").count() == 2
    marts = P.run_batch(spark, _specs(spark), tmpdir_path, out=os.path.join(tmpdir_path, "out"), table_root=root)
    assert marts.dedup.count() == 1  # same posting landed by two loads of one source
    assert {(r.skill, r.job_postings) for r in marts.skill_demand.collect()} == {("SQL", 2)}
    assert set(os.listdir(marts.paths["mart_jobs_curated"])) >= {"posted_date_month=2024-01-01"}


def test_persist_point_uses_checkpoint_dir(spark):
    from hirelake.session import checkpoint_root
    df = spark.range(5).withColumn("x", F.col("id") * 2)
    kept = P.persist_point(df, None)
    assert kept.count() == 5 and sorted(r.x for r in kept.collect()) == [0, 2, 4, 6, 8]
    files = kept.inputFiles()
    assert files and all(f.split(":", 1)[-1].lstrip("/").startswith(checkpoint_root(spark).split(":", 1)[-1].lstrip("/")) for f in files)
