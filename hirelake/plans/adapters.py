"""Adapter: the supplied benchmark tables -> four canonical raw posting tables.

Each rule is deterministic on the table keys, so the same rows can be written
once here (DataFrames) and once as SQL (``oracles.RAW_CTES``).  Rows are never
dropped: key-based rules only blank out or reshape values, and some order rows
are appended again as later or tied loads to exercise deduplication.

| raw table      | from                                  | source_id      |
| raw_orders     | orders + customer + nation + lineitem/part names | src_orders |
| raw_events     | events                                | src_events     |
| raw_documents  | documents                             | src_documents  |
| raw_pages      | pages                                 | src_pages      |

An extra ``row_key`` column identifies the originating row (and copy); it is
not part of the canonical schema and ``conform`` drops it.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import ArrayType, StringType, TimestampNTZType

from hirelake.schema import JOBS_COLUMNS

RAW_TABLES = ("raw_orders", "raw_events", "raw_documents", "raw_pages")
SOURCES = {
    "raw_orders": ("src_orders", "Orders feed"),
    "raw_events": ("src_events", "Events feed"),
    "raw_documents": ("src_documents", "Documents feed"),
    "raw_pages": ("src_pages", "Pages feed"),
}
# Pinned reference dates for date windows over the order-based and the
# event-based sources.
AS_OF_ORDERS = "2001-08-01"
AS_OF_EVENTS = "2024-02-01"

URL_PATH = r"^[A-Za-z][A-Za-z0-9+.-]*://[^/?#]*([^?#]*)"
WORD = r"\p{L}+"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan one supplied table."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def _src(table: str):
    sid, sname = SOURCES[table]
    return F.lit(sid).alias("source_id"), F.lit(sname).alias("source_name")


def _ts(text: str) -> Column:
    return F.lit(text).cast(TimestampNTZType())


def _json_list(names: Column) -> Column:
    """JSON text of a list of plain words (no quotes or backslashes inside)."""
    return F.concat(F.lit('["'), F.array_join(names, '","'), F.lit('"]'))


def order_part_names(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(l_orderkey, names): sorted distinct part names of each order's lines.

    lineitem joins part on the part key (shuffle or size-checked broadcast,
    chosen by Spark), and the names are gathered per order with a set
    aggregate that merges map-side, so one order never ships its duplicates.
    """
    li = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_name")
    pairs = li.join(part, li.l_partkey == part.p_partkey).select("l_orderkey", "p_name")
    return pairs.groupBy("l_orderkey").agg(F.sort_array(F.collect_set("p_name")).alias("names"))


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    o = read_table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", "o_orderdate", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    names = order_part_names(spark, sf_dir)
    base = (o.join(names, o.o_orderkey == names.l_orderkey, "left")
             .join(c, o.o_custkey == c.c_custkey, "left")
             .join(n, c.c_nationkey == n.n_nationkey, "left"))
    k = F.col("o_orderkey")
    has_names = F.col("names").isNotNull() & (F.size("names") > 0)
    skills = (F.when(k % 13 == 0, F.lit(None).cast("string"))
               .when(~has_names, F.lit(None).cast("string"))
               .when(k % 17 == 0, F.lit("not json"))
               .when(k % 19 == 0, F.concat(F.lit('[" ", null, '), ((k % 97) + 1).cast("string"),
                                           F.lit(', "'), F.array_join("names", '","'), F.lit('"]')))
               .otherwise(_json_list(F.col("names"))))
    rows = base.select(
        k.alias("_k"),
        F.concat(F.lit("o:"), k.cast("string")).alias("row_key"),
        *_src("raw_orders"),
        F.when(k % 11 == 0, F.lit(None).cast("string")).when(k % 23 == 0, F.lit("  "))
         .otherwise(F.col("o_orderpriority")).alias("job_title"),
        F.when(k % 7 == 0, F.lit(None).cast("string"))
         .otherwise(F.concat(F.col("o_orderstatus"), F.lit(" order by "), F.col("c_name"))).alias("job_description"),
        F.concat(F.lit("  "), F.col("c_name"), F.lit("\t")).alias("company_name"),
        F.col("n_name").alias("location"),
        F.when(k % 50 == 0, F.lit(None).cast("date")).otherwise(F.to_date("o_orderdate")).alias("posted_date"),
        F.concat(F.lit("HTTPS://Jobs.Example.com/"), (k % 4000).cast("string"), F.lit(" ")).alias("job_url"),
        skills.alias("skills"),
        F.floor("o_totalprice").cast("long").cast("string").alias("salary_info"),
        F.timestamp_add("HOUR", k % 24, F.col("o_orderdate")).alias("ingested_at"),
    )
    # Re-loads, generated in the same pass (no self-union, so the order
    # pipeline runs once): key % 10 = 0 again one day later with a new
    # description; key % 29 = 0 again at the same instant (a tie).
    copies = F.array_except(F.array(F.lit(""), F.when(F.col("_k") % 10 == 0, F.lit("u")),
                                    F.when(F.col("_k") % 29 == 0, F.lit("t"))),
                            F.array(F.lit(None).cast("string")))
    out = rows.withColumn("_copy", F.explode(copies))
    cp = F.col("_copy")
    out = out.withColumn("row_key", F.when(cp == "", F.col("row_key"))
                         .otherwise(F.concat(F.col("row_key"), F.lit(":"), cp))) \
             .withColumn("job_description", F.when(cp == "u", F.lit("updated"))
                         .when(cp == "t", F.lit("duplicate load")).otherwise(F.col("job_description"))) \
             .withColumn("ingested_at", F.when(cp == "u", F.timestamp_add("DAY", F.lit(1), F.col("ingested_at")))
                         .otherwise(F.col("ingested_at")))
    return out.select("row_key", *JOBS_COLUMNS)


def _keep(exclude=()):
    return [F.col(c) for c in JOBS_COLUMNS if c not in exclude]


def raw_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    e = read_table(spark, sf_dir, "events")
    return e.select(
        F.concat(F.lit("e:"), F.col("event_id").cast("string")).alias("row_key"),
        *_src("raw_events"),
        F.col("event_type").alias("job_title"),
        F.lit(None).cast("string").alias("job_description"),
        F.concat(F.lit("user-"), (F.col("user_id") % 50).cast("string")).alias("company_name"),
        F.lit(None).cast("string").alias("location"),
        F.to_date("ts").alias("posted_date"),
        F.concat(F.lit("https://jobs.example.com/"), (F.col("event_id") % 4000).cast("string")).alias("job_url"),
        F.col("props").alias("skills"),
        F.lit(None).cast("string").alias("salary_info"),
        F.col("ts").alias("ingested_at"),
    )


def doc_words(text: Column):
    """First and last word (maximal run of letters) of the whole text."""
    first = F.regexp_extract(text, WORD, 0)
    last = F.reverse(F.regexp_extract(F.reverse(text), WORD, 0))
    return first, last


def raw_documents(spark: SparkSession, sf_dir: str, skills_as_array: bool = False) -> DataFrame:
    d = read_table(spark, sf_dir, "documents")
    first, last = doc_words(F.col("text"))
    has_word = first != ""
    if skills_as_array:
        skills = F.when(has_word, F.array(first, last)).otherwise(F.array().cast(ArrayType(StringType())))
    else:
        skills = F.when(has_word, F.concat(F.lit('["'), first, F.lit('","'), last, F.lit('"]'))).otherwise(F.lit("[]"))
    return d.select(
        F.concat(F.lit("da:" if skills_as_array else "d:"), F.col("doc_id").cast("string")).alias("row_key"),
        *_src("raw_documents"),
        F.concat(F.upper("lang"), F.lit(" document "), F.col("source")).alias("job_title"),
        F.col("text").alias("job_description"),
        F.col("source").alias("company_name"),
        F.col("lang").alias("location"),
        F.date_add(F.lit("2023-01-01").cast("date"), (F.col("doc_id") % 900).cast("int")).alias("posted_date"),
        F.lit(None).cast("string").alias("job_url"),
        skills.alias("skills"),
        F.lit(None).cast("string").alias("salary_info"),
        F.timestamp_add("MINUTE", F.col("doc_id"), _ts("2024-06-01 00:00:00")).alias("ingested_at"),
    )


def raw_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = read_table(spark, sf_dir, "pages")
    return p.select(
        F.concat(F.lit("p:"), F.col("page_id").cast("string")).alias("row_key"),
        *_src("raw_pages"),
        F.regexp_extract("url", URL_PATH, 1).alias("job_title"),
        F.col("html").alias("job_description"),
        F.lit(None).cast("string").alias("company_name"),
        F.lit(None).cast("string").alias("location"),
        F.date_add(F.lit("2024-01-01").cast("date"), (F.col("page_id") % 300).cast("int")).alias("posted_date"),
        F.col("url").alias("job_url"),
        F.lit("[]").alias("skills"),
        F.lit(None).cast("string").alias("salary_info"),
        F.timestamp_add("MINUTE", F.col("page_id"), _ts("2024-06-01 00:00:00")).alias("ingested_at"),
    )


BUILDERS = {"raw_orders": raw_orders, "raw_events": raw_events,
            "raw_documents": raw_documents, "raw_pages": raw_pages}


def raw_tables(spark: SparkSession, sf_dir: str, with_key: bool = False) -> dict[str, DataFrame]:
    """The four raw tables in canonical order."""
    out = {}
    for name in RAW_TABLES:
        df = BUILDERS[name](spark, sf_dir)
        out[name] = df if with_key else df.drop("row_key")
    return out


def register_raw_views(spark: SparkSession, sf_dir: str, names=RAW_TABLES) -> list[str]:
    """Register the raw tables as temp views (the 'warehouse' of the tests)."""
    tables = raw_tables(spark, sf_dir)
    for n in names:
        tables[n].createOrReplaceTempView(n)
    return list(names)


# -----------------------------------------------------------------------------
# File-shaped inputs for the ingestion mappers, derived from documents
# -----------------------------------------------------------------------------

def linkedin_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as a LinkedIn-style CSV (all text columns).

    Headers exercise the substring rules: ``skills_desc`` maps to the
    description (and overwrites it where present), ``company_id`` overwrites
    ``company_name``, ``pay_period`` is salary.  Some dates are old (dropped
    by the recency filter) or unparsable (default date)."""
    d = read_table(spark, sf_dir, "documents")
    first, last = doc_words(F.col("text"))
    i = F.col("doc_id")
    posted = F.date_add(F.lit("2023-01-01").cast("date"), (i % 900).cast("int"))
    return d.select(
        i.cast("string").alias("job_id"),
        F.col("source").alias("company_name"),
        F.concat(F.lit("Document "), F.col("source")).alias("title"),
        F.col("text").alias("description"),
        F.concat(F.col("lang"), F.lit(" ")).alias("location"),
        F.when(i % 3 == 0, F.lit("YEARLY")).alias("pay_period"),
        F.when(i % 41 == 0, F.lit("2019-05-01")).when(i % 37 == 0, F.lit("junk"))
         .otherwise(F.date_format(posted, "yyyy-MM-dd")).alias("posted_date"),
        F.concat(F.lit("https://docs.example.com/"), i.cast("string")).alias("job_link"),
        F.when(i % 5 == 0, F.concat(F.lit("ai "), first)).alias("skills_desc"),
        F.when(i % 4 == 0, F.concat(F.lit("["), first, F.lit("; "), last, F.lit("]")))
         .when(i % 4 == 1, F.concat(first, F.lit(", "), last))
         .when(i % 4 == 2, F.lit(";;"))
         .alias("skills"),
        F.when(i % 2 == 0, F.concat(F.lit("C"), (i % 100).cast("string"))).alias("company_id"),
    )


def de_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders as the 2023 data-engineer CSV: the exact headers plus an extra
    'Office location' header (taken by the substring fallback)."""
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority", "o_orderstatus",
                                                   "o_totalprice")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_name", "c_nationkey", "c_mktsegment")
    n = read_table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    b = o.join(c, o.o_custkey == c.c_custkey, "left").join(n, c.c_nationkey == n.n_nationkey, "left")
    k = F.col("o_orderkey")
    return b.select(
        F.concat(F.col("o_orderpriority"), F.lit(" data engineer")).alias("Job_details"),
        F.when(k % 5 == 0, F.lit("   ")).otherwise(
            F.concat(F.col("o_orderstatus"), F.lit(" pipeline with python and sql for "), F.col("c_name")))
         .alias("Job_details.1"),
        F.col("c_name").alias("Company_info"),
        F.when(k % 3 == 0, F.lit(None)).otherwise(F.col("c_mktsegment")).alias("Job_details.4"),
        F.when(k % 4 == 0, F.lit("")).otherwise(F.lit("CA")).alias("Job_details.5"),
        F.col("n_name").alias("Job_details.6"),
        F.floor(F.col("o_totalprice") / 10).cast("long").cast("string").alias("Salary.2"),
        F.when(k % 2 == 0, F.lit("USD")).alias("Salary.3"),
        F.when(k % 7 == 0, F.lit("Remote")).alias("Office location"),
    )


def hf_like(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as Hugging Face rows: ISO date strings with offsets, list
    columns, exact short titles."""
    d = read_table(spark, sf_dir, "documents")
    first, last = doc_words(F.col("text"))
    i = F.col("doc_id")
    day = F.date_format(F.date_add(F.lit("2023-01-01").cast("date"), (i % 900).cast("int")), "yyyy-MM-dd")
    shorts = ["Data Engineer", "Data Scientist", "Software Engineer", "Data Analyst", "Cloud Engineer"]
    short = F.element_at(F.array(*[F.lit(s) for s in shorts]), ((i % 5) + 1).cast("int"))
    return d.select(
        F.when(i % 4 == 0, F.concat(day, F.lit("T23:30:00-05:00")))
         .when(i % 4 == 1, F.concat(day, F.lit(" 08:00:00")))
         .when(i % 4 == 2, F.concat(day, F.lit(" x")))
         .otherwise(day).alias("job_posted_date"),
        F.concat(F.col("source"), F.lit(" role")).alias("job_title"),
        short.alias("job_title_short"),
        F.array(F.col("text"), F.lit(" "), F.lit(None).cast("string")).alias("job_type_skills"),
        F.when(i % 3 == 0, F.array(first, F.lit("  "), last)).when(i % 3 == 1, F.array().cast("array<string>"))
         .alias("job_skills"),
        F.col("source").alias("company_name"),
        F.col("lang").alias("job_location"),
        F.when(i % 6 != 0, (F.col("n_chars") * F.lit(37.5))).alias("salary_year_avg"),
    )
