"""Mapping of source files onto the canonical posting row.

Header inspection happens once on the driver (it is metadata: a list of
column names); everything per row is a single ``select`` of Column
expressions followed by the recency and domain filters, so the whole mapping
is one narrow stage with no shuffle.
"""
from __future__ import annotations

from functools import reduce
from typing import Sequence

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType

from hirelake.functions.dates import as_date_literal, parse_date_general, parse_iso_date
from hirelake.functions.skills import (extract_taxonomy, merge_skills, skill_list_bracketed,
                                       skill_list_from_array, skill_list_separated, skill_list_single,
                                       skills_blob_text, with_taxonomy)
from hirelake.functions.text import blank_to_null, trim_ws
from hirelake.functions.vocab import (DEFAULT_DATE_DE_2023, DEFAULT_DATE_LINKEDIN_POSTINGS,
                                      DEFAULT_DATE_LINKEDIN_SKILLS, DE_EXACT_COLUMNS, DE_NORMALIZED_COLUMNS,
                                      RECENT_DAYS)
from hirelake.operators.checks import judged
from hirelake.operators.filters import is_data_domain, is_recent
from hirelake.schema import conform

# ---- source identities --------------------------------------------------------------------
HF = ("huggingface_data_jobs", "Hugging Face data_jobs")
DE_2023 = ("kaggle_data_engineer_2023", "Kaggle Data Engineer Job Postings 2023")
LINKEDIN_POSTINGS = ("kaggle_linkedin_postings", "Kaggle LinkedIn Job Postings 2023-2024")
LINKEDIN_SKILLS = ("kaggle_linkedin_jobs_skills_2024", "Kaggle 1.3M LinkedIn Jobs & Skills 2024")


def _c(name: str) -> Column:
    return F.col(f"`{name}`")


def _last_non_null(cols: Sequence[str], blank_skips: bool = False) -> Column:
    """Value of the last listed column that is not NULL (or not blank)."""
    if not cols:
        return F.lit(None).cast("string")
    vals = [blank_to_null(_c(c)) if blank_skips else _c(c) for c in reversed(cols)]
    return F.coalesce(*vals) if len(vals) > 1 else vals[0]


# =============================================================================
# LinkedIn-style CSVs: headers inferred by substring rules
# =============================================================================

# The words that place a header, in order of precedence.
LINKEDIN_WORDS = (("job_title", ("title",)), ("job_description", ("desc", "content")), ("company_name", ("company",)),
                  ("location", ("loc", "place")), ("salary_info", ("salary", "pay")),
                  ("posted_date", ("posted", "date", "time")), ("job_url", ("url", "link")), ("skills", ("skill",)))
DE_WORDS = (("job_title", ("title",)), ("job_description", ("desc",)), ("location", ("loc",)),
            ("company_name", ("company",)), ("salary_info", ("salary",)))


def field_of(header: str, words, taken=()) -> str | None:
    """The first field, not yet taken, one of whose words the header contains."""
    return next((f for f, ws in words if f not in taken and any(w in header for w in ws)), None)


def linkedin_column_map(columns: Sequence[str], variant: str = "postings") -> dict[str, list[str]]:
    """field -> its columns, in file order.  The skills variant also reads a
    header that is just 'job' as a title."""
    exact = {"job": "job_title"} if variant == "skills" else {}
    placed = [(exact.get(h) or field_of(h, LINKEDIN_WORDS), c) for c in columns for h in [str(c).lower().strip()]]
    return {f: [c for g, c in placed if g == f] for f in dict.fromkeys(f for f, _ in placed if f)}


def selected(mapped: DataFrame, conditions: dict[str, Column], judge: bool, defaulted: dict[str, Column] | None = None) -> DataFrame:
    """The rows for which no condition is true; with ``judge`` all rows, with the names of the true ones (see ``operators.checks``)."""
    if judge:
        return judged(mapped, conditions, defaulted)
    return mapped.where(reduce(lambda a, b: a & b, [~c for c in conditions.values()]))


def map_linkedin(df: DataFrame, variant: str = "postings", as_of=None, ingested_at: Column | None = None,
                 epoch_unit: str | None = None, days: int = RECENT_DAYS, judge: bool = False) -> DataFrame:
    """LinkedIn-style rows -> canonical rows, recent and data-domain only.

    * posted date: the first date-like column, parsed; unparsable or absent ->
      the source's default date.
    * title / description: the last non-NULL mapped value, trimmed, blank -> NULL.
    * company / location / salary / url: the last non-NULL value, trimmed.
    * skills: split by the variant's rule ((b) for postings, (c) for skills).
    * with ``judge`` all mapped rows, each with its reject reasons and whether its date is the default.
    """
    sid, sname = LINKEDIN_POSTINGS if variant == "postings" else LINKEDIN_SKILLS
    default = DEFAULT_DATE_LINKEDIN_POSTINGS if variant == "postings" else DEFAULT_DATE_LINKEDIN_SKILLS
    fields = linkedin_column_map(df.columns, variant)
    posted_cols = fields.get("posted_date", [])
    parsed = parse_date_general(_c(posted_cols[0]), epoch_unit) if posted_cols else F.lit(None).cast("date")
    posted = F.coalesce(parsed, as_date_literal(default)) if posted_cols else as_date_literal(default)
    skills_raw = _last_non_null(fields.get("skills", []))
    rule = skill_list_bracketed if variant == "postings" else skill_list_separated
    trimmed = {f: trim_ws(_last_non_null(fields.get(f, [])))
               for f in ("company_name", "location", "salary_info", "job_url")}
    mapped = df.select(
        F.lit(sid).alias("source_id"), F.lit(sname).alias("source_name"),
        blank_to_null(_last_non_null(fields.get("job_title", []))).alias("job_title"),
        blank_to_null(_last_non_null(fields.get("job_description", []))).alias("job_description"),
        trimmed["company_name"].alias("company_name"),
        trimmed["location"].alias("location"),
        posted.alias("posted_date"),
        trimmed["job_url"].alias("job_url"),
        rule(skills_raw).alias("skills"),
        trimmed["salary_info"].alias("salary_info"),
        (ingested_at if ingested_at is not None else F.localtimestamp()).alias("ingested_at"),
        *([parsed.isNull().alias("_undated")] if judge else []),
    )
    kept = selected(mapped, {"not_recent": ~is_recent("posted_date", as_of, days),
                             "not_data_domain": ~is_data_domain("job_title", "job_description", "skills")},
                    judge, {"posted_date": F.col("_undated")})
    return kept.drop("_undated") if judge else conform(kept, skills_as="keep")


# =============================================================================
# Data-engineer 2023 CSV: exact, normalized and substring column maps
# =============================================================================

HEADER_JOINTS = str.maketrans(" -", "__")


def de_column_map(columns: Sequence[str]) -> list[tuple[str, str]]:
    """(column, field) pairs in the order values are applied (later wins).

    The exact headers decide if there is any, else the normalized ones; the
    columns left over are placed by word, a field that has a column no more.
    """
    plain = {c: str(c).strip().lower().translate(HEADER_JOINTS) for c in columns}
    pairs = ([(c, f) for c, f in DE_EXACT_COLUMNS.items() if c in plain]
             or [(c, DE_NORMALIZED_COLUMNS[n]) for c, n in plain.items() if n in DE_NORMALIZED_COLUMNS])
    used = {c for c, _ in pairs}
    for c in (c for c in plain if c not in used):
        field = field_of(plain[c], DE_WORDS, {f for _, f in pairs})
        if field:
            pairs.append((c, field))
    return pairs


def map_de_2023(df: DataFrame, as_of=None, extract_skills: bool = False, ingested_at: Column | None = None,
                days: int = RECENT_DAYS, taxonomy=None) -> DataFrame:
    """Data-engineer CSV rows -> canonical rows (no domain filter: the whole
    file is data-engineering).  Blank values never overwrite earlier ones."""
    pairs = de_column_map(df.columns)

    def field(*names: str) -> Column:
        return _last_non_null([c for c, f in pairs if f in names], blank_skips=True)

    title, desc = field("job_title"), field("job_description")
    location = F.coalesce(field("location"),
                          F.nullif(F.concat_ws(", ", field("location_city"), field("location_state"),
                                               field("location_country")), F.lit("")))
    salary = F.nullif(F.concat_ws(" ", field("salary_info", "salary_avg"), field("salary_currency")), F.lit(""))
    posted = as_date_literal(DEFAULT_DATE_DE_2023)
    mapped = df.select(
        F.lit(DE_2023[0]).alias("source_id"), F.lit(DE_2023[1]).alias("source_name"),
        title.alias("job_title"), desc.alias("job_description"), field("company_name").alias("company_name"),
        location.alias("location"), posted.alias("posted_date"), F.lit(None).cast("string").alias("job_url"),
        F.lit(None).cast(ArrayType(StringType())).alias("skills"), salary.alias("salary_info"),
        (ingested_at if ingested_at is not None else F.localtimestamp()).alias("ingested_at"),
    )
    kept = mapped.where(is_recent("posted_date", as_of, days))
    if extract_skills:
        # the hits are a column first, so the test for none does not repeat the extraction
        kept = with_taxonomy(kept, "job_title", "job_description", "_tax", taxonomy)
        kept = kept.withColumn("skills", F.when(F.size("_tax") > 0, F.col("_tax")))
    return conform(kept, skills_as="keep")


# =============================================================================
# Hugging Face data_jobs rows (Parquet)
# =============================================================================

def hf_posted_date(c: Column, dtype: DataType) -> Column:
    from pyspark.sql.types import DateType, TimestampNTZType, TimestampType
    if isinstance(dtype, DateType):
        return c
    if isinstance(dtype, (TimestampType, TimestampNTZType)):
        return F.to_date(c)
    return parse_iso_date(c)


def python_float_text(c: Column) -> Column:
    """str(float) as Python prints it: plain digits from 0.0001 to below 1e16,
    else an exponent of at least two digits; 'nan', 'inf'."""
    text = c.cast("string")
    size = F.abs(c)
    plain = F.regexp_replace(c.try_cast("decimal(38,20)").cast("string"), r"(\.\d+?)0+$", "$1")
    digits, power = F.regexp_extract(text, r"^(.*?)(?:\.0)?E", 1), F.regexp_extract(text, r"E(-?\d+)$", 1)
    sign = F.when(power.startswith("-"), F.lit("e-")).otherwise(F.lit("e+"))
    scientific = F.concat(digits, sign, F.regexp_replace(F.regexp_replace(power, "^-", ""), r"^(\d)$", "0$1"))
    return (F.when(c.isNull(), F.lit(None).cast("string"))
             .when(F.isnan(c), F.lit("nan"))
             .when(size == F.lit(float("inf")), F.when(c > 0, F.lit("inf")).otherwise(F.lit("-inf")))
             .when(~text.contains("E"), text)
             .when((size >= 1e-4) & (size < 1e16), plain)
             .otherwise(scientific))


def map_hf(df: DataFrame, as_of=None, extract_skills: bool = False, ingested_at: Column | None = None,
           days: int = RECENT_DAYS, taxonomy=None, judge: bool = False) -> DataFrame:
    """Hugging Face rows -> canonical rows, recent and data-domain only.

    The free-text ``job_type_skills`` becomes the description; ``job_skills``
    the skills list.  With ``extract_skills`` the taxonomy fills missing
    skills or is merged after the given ones.
    """
    sch = {f.name: f.dataType for f in df.schema.fields}

    def col(name: str) -> Column:
        return F.col(name) if name in sch else F.lit(None).cast("string")

    posted = hf_posted_date(col("job_posted_date"), sch.get("job_posted_date", StringType()))
    desc = skills_blob_text(col("job_type_skills"), sch.get("job_type_skills"))
    js_type = sch.get("job_skills")
    skills = skill_list_from_array(col("job_skills")) if isinstance(js_type, ArrayType) \
        else skill_list_single(col("job_skills"))
    title = col("job_title").cast("string")
    salary = python_float_text(col("salary_year_avg").cast("double")) if "salary_year_avg" in sch \
        else F.lit(None).cast("string")
    mapped = df.select(
        F.lit(HF[0]).alias("source_id"), F.lit(HF[1]).alias("source_name"),
        title.alias("job_title"), desc.alias("job_description"),
        col("company_name").cast("string").alias("company_name"),
        col("job_location").cast("string").alias("location"),
        posted.alias("posted_date"), F.lit(None).cast("string").alias("job_url"),
        F.coalesce(skills, F.lit(None).cast(ArrayType(StringType()))).alias("_given"),
        salary.alias("salary_info"),
        (ingested_at if ingested_at is not None else F.localtimestamp()).alias("ingested_at"),
        col("job_title_short").cast("string").alias("_short"),
    )
    # The domain test sees the given skills, before any taxonomy merge.
    kept = selected(mapped, {"no_date": F.col("posted_date").isNull() & F.lit(judge),
                             "not_recent": ~is_recent("posted_date", as_of, days),
                             "not_data_domain": ~is_data_domain("job_title", "job_description", "_given", job_title_short="_short")}, judge)
    if extract_skills:
        # Taxonomy hits become a column first, so the merge below refers to
        # them instead of repeating the whole extraction expression.
        kept = kept.withColumn("_tax", extract_taxonomy(blank_to_null("job_title"), "job_description", taxonomy))
        kept = kept.withColumn("skills", merge_skills("_given", "_tax"))
    else:
        kept = kept.withColumn("skills", F.col("_given"))
    return kept.drop("_given", "_short", "_tax") if judge else conform(kept, skills_as="keep")


__all__ = ["linkedin_column_map", "map_linkedin", "de_column_map", "map_de_2023", "map_hf"]
