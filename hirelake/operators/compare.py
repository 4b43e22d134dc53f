"""Comparison of two skill extractors on a sample, and its summary."""
from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from hirelake.functions.skills import empty_list, hybrid_skills, jaccard, with_taxonomy
from hirelake.functions.text import blank_to_null, col_of
from hirelake.functions.vocab import COMPARE_SAMPLE, SNIPPET_CHARS
from hirelake.operators.filters import has_title_or_description


def sample_nonblank(df: DataFrame, n: int | None = COMPARE_SAMPLE, order_by=("row_id",),
                    title="job_title", description="job_description") -> DataFrame:
    """First ``n`` rows (by ``order_by``) with a non-blank title or description.

    The limit is the operator (a sample); the order makes it repeatable.  With
    ``n=None`` every such row is returned, in no order.
    """
    rows = df.where(has_title_or_description(title, description))
    if n is None:
        return rows
    return rows.orderBy(*[col_of(c).asc_nulls_last() for c in order_by]).limit(int(n))


def compare_skills(df: DataFrame, row_id="row_id", title="job_title", description="job_description",
                   other="skills_other", taxonomy=None, snippet_chars: int = SNIPPET_CHARS) -> DataFrame:
    """Per row: taxonomy skills vs another extractor's list, with Jaccard.

    ``other`` is any ``array<string>`` column: a list already in the table or
    the output of :func:`hirelake.operators.enrich.enrich`.
    """
    df = with_taxonomy(df, title, description, "_tax", taxonomy)  # a column first, so it is computed once
    t, d, tax = blank_to_null(title), blank_to_null(description), F.col("_tax")
    oth = F.coalesce(col_of(other), empty_list())
    desc = F.coalesce(d, F.lit(""))
    snippet = F.when(F.length(desc) > snippet_chars,
                     F.concat(F.substring(desc, 1, snippet_chars), F.lit("..."))).otherwise(desc)
    return df.select(
        col_of(row_id).alias("row_id"),
        F.coalesce(t, F.lit("")).alias("job_title"),
        snippet.alias("description_snippet"),
        F.array_join(tax, "|").alias("skills_taxonomy"),
        F.array_join(oth, "|").alias("skills_llm"),
        F.format_string("%.4f", F.bround(jaccard(tax, oth), 4)).alias("jaccard_similarity"),
    )


def compare_summary(cmp: DataFrame) -> DataFrame:
    """Mean Jaccard (of the printed values), non-empty counts and shares, and
    mean list size among non-empty rows, for both extractors."""
    n = F.count(F.lit(1))
    tax_ne = F.col("skills_taxonomy") != ""
    oth_ne = F.col("skills_llm") != ""
    return cmp.agg(
        n.alias("rows"),
        F.bround(F.avg(F.col("jaccard_similarity").cast("double")), 4).alias("mean_jaccard"),
        F.count_if(tax_ne).alias("taxonomy_nonempty"),
        F.count_if(oth_ne).alias("llm_nonempty"),
        F.bround(F.count_if(tax_ne) * 100.0 / n, 1).alias("taxonomy_nonempty_pct"),
        F.bround(F.count_if(oth_ne) * 100.0 / n, 1).alias("llm_nonempty_pct"),
        F.bround(F.avg(F.when(tax_ne, F.size(F.split("skills_taxonomy", r"\|")))), 2).alias("taxonomy_mean_size"),
        F.bround(F.avg(F.when(oth_ne, F.size(F.split("skills_llm", r"\|")))), 2).alias("llm_mean_size"),
    )


def hybrid_fill(df: DataFrame, primary="skills_normalized", title="job_title",
                description="job_description", taxonomy=None, out="skills_hybrid") -> DataFrame:
    """Keep a row's own skills; where it has none, fill from the taxonomy.

    The taxonomy hits are projected as a column first: used inside a
    conditional branch, the extraction would not share its text expression
    and the generated code would outgrow the JVM's method size limit.
    """
    tmp = f"_{out}_taxonomy"
    with_tax = with_taxonomy(df, title, description, tmp, taxonomy)
    return with_tax.withColumn(out, hybrid_skills(primary, tmp)).drop(tmp)
