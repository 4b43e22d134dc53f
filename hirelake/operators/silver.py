"""Silver layer: union of sources, standardization, deduplication, skill rows."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window, functions as F
from pyspark.sql.types import ArrayType

from hirelake.functions.flags import has_text
from hirelake.functions.fingerprint import dedup_key, fingerprint
from hirelake.functions.skills import normalize_skills
from hirelake.functions.text import blank_to_null, trim_ws
from hirelake.schema import conform


#: Where a stored row lies: a digest of its file's path, and its place in the file.
LOCATOR = ("_file", "_row")


def located(df: DataFrame) -> DataFrame:
    """The columns and the ``LOCATOR`` of every row.  Rows that do not come straight from Parquet files are stored first."""
    from hirelake.session import scratch_path

    place = [F.unhex(F.md5(F.col("_metadata.file_path").cast("binary"))).alias("_file"), F.col("_metadata.row_index").alias("_row")]
    if df._jdf.queryExecution().analyzed().getClass().getSimpleName() != "LogicalRelation":  # only a bare scan's places are its rows'
        path = scratch_path(df.sparkSession, "landed")
        df.write.parquet(path)
        df = df.sparkSession.read.schema(df.schema).parquet(path)
    return df.select("*", *place)


def union_all(frames: list[DataFrame], skills_as: str = "json", locate: bool = False) -> DataFrame:
    """UNION ALL of canonical frames, in the order given.

    Every input is projected to the canonical columns first, so positional and
    by-name union agree.  No input at all is an error.  ``locate`` adds the
    ``LOCATOR`` columns (see :func:`located`).
    """
    frames = [f for f in frames if f is not None]
    if not frames:
        raise ValueError("no source tables are present: nothing to union")
    if locate:
        frames = [located(f) for f in frames]
    keep = {c: c for c in LOCATOR} if locate else {}
    projected = [conform(f, skills_as=skills_as, on_invalid="keep", keep=keep) for f in frames]
    return reduce(lambda a, b: a.unionByName(b), projected)


def standardize(df: DataFrame, keep=()) -> DataFrame:
    """Trim text, NULL-if-blank, skills -> clean array, URL match key.

    ``keep`` names extra columns to carry through unchanged (e.g. a row id).
    """
    dtype = df.schema["skills"].dataType
    return df.select(*keep,
        "source_id", "source_name",
        blank_to_null("job_title").alias("job_title"),
        blank_to_null("job_description").alias("job_description"),
        blank_to_null("company_name").alias("company_name"),
        blank_to_null("location").alias("location"),
        "posted_date",
        blank_to_null("job_url").alias("job_url"),
        F.lower(blank_to_null("job_url")).alias("job_url_normalized"),
        normalize_skills("skills", dtype).alias("skills_normalized"),
        "salary_info",
        "ingested_at",
        F.col("skills").alias("skills_raw"),
    )


def with_dedup_key(df: DataFrame, standard: bool = False) -> DataFrame:
    return (df.withColumn("_dedup_key", dedup_key(standard=standard))
              .withColumn("_dedup_fingerprint", fingerprint("_dedup_key")))


#: Besides ``ingested_at`` and ``job_url``, what tells two rows of a key apart.
TIE_COLUMNS = ("source_name", "job_title", "job_description", "company_name", "location", "skills_raw", "salary_info")


def row_digest(df: DataFrame, columns) -> Column:
    """128-bit digest of the columns' texts (lists as JSON; a null differs from every text)."""
    texts = [F.to_json(c) if isinstance(df.schema[c].dataType, ArrayType) else F.col(c).cast("string") for c in columns]
    parts = [F.coalesce(t, F.lit("\x01")) for t in texts]
    return F.md5(F.concat_ws("\x1f", *parts).cast("binary"))


def deduplicate(df: DataFrame, keep_key: bool = False, tie_breakers=()) -> DataFrame:
    """One row per dedup key of a source: latest ``ingested_at`` wins.

    Ties fall to ``job_url`` and then to one fixed-size digest of all other
    content, so the winner does not depend on the input order.  The window is
    partitioned by a 128-bit digest of the key (null stays null), and the text
    flags that the counts need are taken here, before the shuffle: a query that
    does not return texts does not move them.  ``row_number() = 1`` lets Spark
    insert a partial group limit before the shuffle, so a hot key (e.g. all
    undated postings of a source, whose key is NULL) is cut down map-side.
    """
    ties = [c for c in (*TIE_COLUMNS, *tie_breakers) if c in df.columns]
    keyed = (with_dedup_key(df).withColumn("_dedup_group", F.md5(F.col("_dedup_key").cast("binary")))
             .withColumn("_dedup_tie", row_digest(df, ties))
             .withColumn("_has_title", has_text("job_title")).withColumn("_has_description", has_text("job_description")))
    if not keep_key:
        keyed = keyed.drop("_dedup_key")
    w = Window.partitionBy("source_id", "_dedup_group").orderBy(
        F.col("ingested_at").desc_nulls_last(), F.col("job_url").asc_nulls_last(), F.col("_dedup_tie").asc())
    out = keyed.withColumn("_dedup_rank", F.row_number().over(w)).where(F.col("_dedup_rank") == 1)
    return out.drop("_dedup_rank", "_dedup_group", "_dedup_tie")


#: What the marts need of a posting, texts apart.
NARROW = ("source_id", "posted_date", "job_url", "job_url_normalized", "skills_normalized", "ingested_at")


def ranking_keys(df: DataFrame, locator=LOCATOR, tie_breakers=(), carry=NARROW, standard: bool = False) -> DataFrame:
    """What ranks the rows of ``df`` without their texts, and the ``carry`` columns.

    Texts of ``standard`` rows are not trimmed once more.  That also keeps the
    generated method below the 8000 bytes beyond which the JVM only interprets it.
    """
    ties = [c for c in (*TIE_COLUMNS, *tie_breakers) if c in df.columns]
    names = list(dict.fromkeys([*locator, "source_id", "ingested_at", "job_url", *carry]))
    flags = {f"_has_{x}": F.col(f"job_{x}").isNotNull() if standard else has_text(f"job_{x}") for x in ("title", "description")}
    return with_dedup_key(df, standard).select(
        *names, F.md5(F.col("_dedup_key").cast("binary")).alias("_dedup_group"), "_dedup_fingerprint", row_digest(df, ties).alias("_dedup_tie"),
        *[c.alias(n) for n, c in flags.items()])


def deduplicate_late(df: DataFrame, locator=LOCATOR, tie_breakers=(), carry=NARROW, make=None) -> tuple[DataFrame, DataFrame]:
    """The rows of :func:`deduplicate`, twice: their narrow columns, and whole.

    ``make`` turns the rows of ``df`` into standard ones (:func:`standardize`),
    one by one, and keeps the locator.  It is applied to all rows for the
    columns that ranking and ``carry`` take, and whole to those that stay,
    behind the join: losers are neither parsed nor trimmed again.

    Rows are ranked without their texts: the key's digest, load time, tie
    digest and the ``locator``, which must name a row and be the same whenever
    ``df`` is read again.  The narrow winners (``carry``, the text flags and the
    locator) are written; the whole rows are ``df`` less the written losers, so
    texts are read once more and never sorted.  The losers are broadcast while
    Spark's threshold holds their measured size; beyond it both sides are
    hashed by the locator, and only the losers' narrow side builds a table.
    """
    from hirelake.session import scratch_path

    spark, made = df.sparkSession, df if make is None else make(df)

    def written(rows: DataFrame, name: str) -> DataFrame:
        path = scratch_path(spark, name)
        rows.write.parquet(path)
        return spark.read.schema(rows.schema).parquet(path)

    keys = written(ranking_keys(made, locator, tie_breakers, carry, standard=make is not None), "dedup_keys")
    # the digest first: it tells rows apart in the first bytes that a sort compares
    w = Window.partitionBy("_dedup_group", "source_id").orderBy(
        F.col("ingested_at").desc_nulls_last(), F.col("job_url").asc_nulls_last(), F.col("_dedup_tie").asc(), *locator)
    winners = written(keys.withColumn("_dedup_rank", F.row_number().over(w)).where(F.col("_dedup_rank") == 1)
                      .drop("_dedup_rank", "_dedup_group", "_dedup_tie"), "dedup_winners")
    losers = written(keys.select(*locator).join(winners.select(*locator), list(locator), "left_anti"), "dedup_losers")
    size = int(str(losers._jdf.queryExecution().optimizedPlan().stats().sizeInBytes()))
    most = spark._jsparkSession.sessionState().conf().autoBroadcastJoinThreshold()
    if size > most:
        losers = losers.hint("shuffle_hash")
    kept = df.join(losers, list(locator), "left_anti")
    whole = (kept if make is None else make(kept)).drop(*[c for c in locator if c in LOCATOR])
    return winners, whole


def skills_long(dedup: DataFrame) -> DataFrame:
    """One row per (posting, skill); postings without skills vanish."""
    names = [c for c in ("source_id", "source_name", "job_title", "company_name", "posted_date", "job_url", "ingested_at") if c in dedup.columns]
    exploded = dedup.select(*names, F.explode("skills_normalized").alias("skill"))
    return (exploded.withColumn("skill", trim_ws("skill"))
                    .where(F.col("skill").isNotNull() & (F.col("skill") != "")))
