"""The batch chain: ingest -> load -> master -> silver/gold marts.

One Spark application runs the layers in order.  Duplicates are ranked once,
without texts, and the winners' narrow columns are written to the scratch folder
for the marts; that also cuts the lineage, so a lost executor re-reads files
instead of replaying the whole chain.
"""
from __future__ import annotations

import logging
from dataclasses import dataclass, field
from typing import Callable

from pyspark.sql import DataFrame, SparkSession

from hirelake.operators import gold as G
from hirelake.operators import master as M
from hirelake.operators import silver as S
from hirelake.schema import conform
from hirelake.session import scratch_path
from hirelake.sources import sinks
from hirelake.sources.catalog import RAW_TABLE_IDS, present_sources
from hirelake.sources.versions import Lake, Run

log = logging.getLogger(__name__)


@dataclass
class SourceSpec:
    """One source: a function producing its canonical rows, and where it lands."""
    name: str
    dataset: str
    table: str
    build: Callable[[SparkSession], DataFrame]


@dataclass
class Marts:
    dedup: DataFrame
    curated: DataFrame
    posting_volume: DataFrame
    skill_demand: DataFrame
    cross_source_urls: DataFrame
    paths: dict = field(default_factory=dict)


def ingest(spark: SparkSession, sources: list[SourceSpec], base: str, only: str | None = None,
           run_id: str | None = None) -> list[str]:
    """Map and stage each source in order, then publish all of them in one step.

    The first failure stops the run and leaves the lake as it was.  With the
    ``run_id`` of a run that failed, the sources that it had staged are not
    mapped again.
    """
    lake, run = Lake(spark, base), Run(spark, base, run_id)
    staged = {}
    chosen = [spec for spec in sources if not only or spec.name == only]
    for spec in chosen:
        version = run.version(spec.name)
        if version is None:
            version = lake.stage(spec.dataset, conform(spec.build(spark), skills_as="keep"))
            run.record(spec.name, version)
        staged[spec.dataset] = version
    if staged:
        lake.publish(staged)
    return [spec.name for spec in chosen]


def load(spark: SparkSession, sources: list[SourceSpec], base: str, only: str | None = None,
         table_root: str | None = None) -> list[str]:
    loaded = []
    for spec in sources:
        if only and spec.name != only:
            continue
        if sinks.load_raw_table(spark, base, spec.dataset, spec.table, table_root):
            loaded.append(spec.table)
    return loaded


def persist_point(df: DataFrame, path: str | None) -> DataFrame:
    """Write a reused intermediate once; read it back for every consumer."""
    spark = df.sparkSession
    path = path or scratch_path(spark, "persisted")  # Parquet either way, so that consumers read only their columns
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


def build_marts(raw_frames: list[DataFrame], out: str | None = None) -> Marts:
    """Silver + gold from the raw tables (stored ones are read in place).  With ``out`` the two partitioned marts are written under it.

    Duplicates are ranked without texts; the narrow winners feed the three
    aggregated marts, and only the curated one reads texts again.
    """
    winners, dedup = S.deduplicate_late(S.union_all(raw_frames, locate=True), make=lambda rows: S.standardize(rows, keep=S.LOCATOR))
    curated = G.curate(dedup)
    volume = G.posting_volume(winners)
    marts = Marts(dedup, curated, volume, G.skill_demand(S.skills_long(winners)), G.cross_source_urls(winners))
    if out:
        marts.paths["mart_jobs_curated"] = sinks.write_partitioned(
            curated, f"{out}/mart_jobs_curated", "posted_date", ("source_id", "content_quality_bucket"))
        marts.paths["mart_posting_volume"] = sinks.write_partitioned(
            volume, f"{out}/mart_posting_volume", "posting_month", ("source_id",), month_col="posting_month_part")
    return marts


def run_batch(spark: SparkSession, sources: list[SourceSpec], base: str, out: str | None = None,
              skip_models: bool = False, master: str = "master_jobs",
              table_root: str | None = None, run_id: str | None = None) -> Marts | None:
    """ingest -> load -> master view -> marts (unless ``skip_models``).  ``run_id`` resumes a run whose ingest failed."""
    ingest(spark, sources, base, run_id=run_id)
    load(spark, sources, base, table_root=table_root)
    present = present_sources(spark, [s.table for s in sources] or list(RAW_TABLE_IDS))
    if not present:
        raise ValueError("no raw tables loaded")
    frames = [spark.table(t) for t in present]
    sinks.create_master_view(spark, M.master_clean(frames), master)
    if skip_models:
        return None
    return build_marts([sinks.stored_raw_table(spark, t, table_root) for t in present], out)
