"""Skill extraction with taxonomies of any size: word n-grams joined with a table of terms.

``functions.skills.taxonomy_hits`` tests one pattern after the other, so its
plan and its cost grow with the taxonomy.  Here a text is cut into its words
(runs of word characters, as a regular expression's word boundary sees them)
and what lies between them; a pattern occurs as a whole word exactly where a run
of whole words, with the text between them, equals its core (from its first word
to its last).  So an equi-join of the n-grams of a text with the terms
finds all occurrences at once, whatever the number of terms, and Spark
broadcasts the terms only while they are small.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from hirelake.functions.skills import default_taxonomy, empty_list, extraction_text, regex_escape
from hirelake.functions.text import col_of

WORD = r"(?U)\w+"


def words_and_gaps(text: Column) -> tuple[Column, Column]:
    """The words of a text, and what stands before, between and after them (one more than words)."""
    return F.regexp_extract_all(text, F.lit(f"({WORD})"), 1), F.split(text, WORD, -1)


def taxonomy_table(spark: SparkSession, taxonomy=None) -> DataFrame:
    """(pattern, canonical) rows of a taxonomy given as pairs (the built-in one by default)."""
    return spark.createDataFrame(list(taxonomy or default_taxonomy()), "pattern string, canonical string")


def term_keys(terms: DataFrame) -> DataFrame:
    """(core, before, after, n, canonical): what an n-gram must equal, and the gaps that must stand next to it.

    A pattern that begins (or ends) with other than a word character matches
    only where a word stands before (after) it, because the boundary asks for
    one; then the whole gap must be the pattern's.  ``n`` is 0 for patterns
    without a word.
    """
    t = terms.where("pattern is not null and canonical is not null").select(F.lower("pattern").alias("p"), "canonical")
    words, gaps = words_and_gaps(F.col("p"))
    t = t.withColumn("n", F.size(words)).withColumn("before", gaps[0]).withColumn("after", F.when(F.col("n") > 0, F.element_at(gaps, -1)))
    core = F.expr("substring(p, length(before) + 1, length(p) - length(before) - length(after))")
    return t.select(F.when(F.col("n") > 0, core).otherwise(F.col("p")).alias("core"), "before", "after", "n", "canonical").distinct()


def _ngrams(words: Column, gaps: Column, sizes: list[int]) -> Column:
    """(core, before, after) of all n-grams of the given sizes; a gap at the text's edge counts as null."""
    def of(n):
        last = F.size(words) - n
        starts = F.when(last >= 0, F.sequence(F.lit(0), last))

        def gram(i):
            parts = [x for k in range(n) for x in ((F.get(gaps, i + k),) if k else ()) + (F.get(words, i + k),)]
            return F.struct(F.concat(*parts).alias("core"), F.when(i > 0, F.get(gaps, i)).alias("before"),
                            F.when(i < last, F.get(gaps, i + n)).alias("after"))
        return F.transform(F.coalesce(starts, F.array().cast("array<int>")), gram)
    # repeats are left to the join's result: distinct structs of one array are found by comparing all with all
    return F.flatten(F.array(*[of(n) for n in sizes]))


def taxonomy_matches(df: DataFrame, key: str, terms: DataFrame, title="job_title", description="job_description") -> DataFrame:
    """(key, canonical): the distinct names whose patterns occur as whole words in title + description.

    ``terms`` has (pattern, canonical); repeated ones count once, nulls are
    left out.  Sizes of terms are collected (a handful of numbers); patterns
    without any word character, which no n-gram can find, are tested one by one.
    """
    keys = term_keys(terms)
    sizes = sorted(r.n for r in keys.select("n").distinct().collect())
    texts = df.select(F.col(key), extraction_text(title, description).alias("t"))
    found = texts.where("false").select(key, F.lit("").alias("canonical"))
    longer = [n for n in sizes if n > 0]
    if longer:
        words, gaps = words_and_gaps(F.col("t"))
        cut = texts.select(key, words.alias("w"), gaps.alias("g"))
        grams = cut.select(key, F.explode(_ngrams(F.col("w"), F.col("g"), longer)).alias("x")).select(key, "x.*")
        at = keys.where("n > 0").select(F.col("core").alias("c"), F.col("before").alias("b"), F.col("after").alias("a"), "canonical")
        fits = ((F.col("core") == F.col("c")) & ((F.col("b") == "") | (F.col("before") == F.col("b")))
                & ((F.col("a") == "") | (F.col("after") == F.col("a"))))
        found = grams.join(at, fits).select(key, "canonical")
    if 0 in sizes:
        for r in keys.where("n = 0 and core != ''").select("core", "canonical").distinct().collect():
            hits = texts.where(F.col("t").contains(r["core"]) & F.col("t").rlike(rf"(?U)\b(?:{regex_escape(r['core'])})\b"))
            found = found.unionByName(hits.select(key, F.lit(r.canonical).alias("canonical")))
    return found.distinct()


def with_taxonomy_table(df: DataFrame, key: str, terms: DataFrame, title="job_title", description="job_description",
                        out: str = "skills_taxonomy") -> DataFrame:
    """All columns and the sorted names found, [] if none.  ``key`` names a row (rows with one key share their names)."""
    names = taxonomy_matches(df, key, terms, title, description).groupBy(key).agg(F.sort_array(F.collect_set("canonical")).alias(out))
    joined = df.join(names.withColumnRenamed(key, "_taxonomy_key"), F.col(key) == F.col("_taxonomy_key"), "left").drop("_taxonomy_key")
    return joined.withColumn(out, F.coalesce(col_of(out), empty_list()))
