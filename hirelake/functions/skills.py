"""Skill-list expressions: normalization, parsing, taxonomy extraction, set metrics.

All of them are built from Spark's higher-order array functions (``transform``,
``filter``, ``array_distinct`` ...) so they stay inside whole-stage codegen and
never need a Python UDF or a shuffle.
"""
from __future__ import annotations

from functools import reduce
from pyspark.sql import Column, functions as F
from pyspark.sql.types import ArrayType, DataType, StringType

from hirelake.functions.text import blank_to_null, col_of, once, trim_ws
from hirelake.functions.vocab import SKILL_ALIASES, SKILL_PATTERNS

def empty_list() -> Column:
    """An empty ``array<string>`` literal."""
    return F.array().cast(ArrayType(StringType()))

# A complete JSON array whose elements are all scalars (string, number, true,
# false, null).  Used to gate from_json, which is laxer than a strict parser: it
# accepts single quotes and trailing text, and stringifies nested values.
# Possessive quantifiers keep the scan linear on long inputs.
_JSON_STR = r'"[^"\\\x00-\x1f]*+(?:\\(?:["\\/bfnrt]|u[0-9a-fA-F]{4})[^"\\\x00-\x1f]*+)*+"'
_JSON_NUM = r"-?(?:0|[1-9]\d*+)(?:\.\d++)?+(?:[eE][+-]?+\d++)?+"
_JSON_EL = rf"(?:{_JSON_STR}|{_JSON_NUM}|true|false|null)"
_JS = r"[ \t\n\r]*+"
JSON_SCALAR_ARRAY = rf"^\[{_JS}(?:{_JSON_EL}{_JS}(?:,{_JS}{_JSON_EL}{_JS})*+)?+\]$"


def clean_list(arr) -> Column:
    """Trim every element and drop NULL / blank ones; order and repeats kept."""
    return F.filter(F.transform(col_of(arr), trim_ws), lambda x: x != F.lit(""))


def json_scalar_array(text) -> Column:
    """Parse JSON-array text to ``array<string>``; NULL unless it is a strict
    array of scalars.  Numbers and booleans become their JSON text."""
    return once(trim_ws(text), lambda t: F.when(t.rlike(JSON_SCALAR_ARRAY), F.from_json(t, ArrayType(StringType()))))


def normalize_skills(c, dtype: DataType | None = None) -> Column:
    """Raw ``skills`` (JSON text or array<string>) -> clean ``array<string>``.

    Anything that is not an array (an object, a bare string, invalid JSON, JSON
    null, SQL NULL) becomes the empty array.  Elements are trimmed; blanks and
    nulls are dropped; no de-duplication and no case folding.
    """
    c = col_of(c)
    if isinstance(dtype, ArrayType):
        arr = c.cast(ArrayType(StringType()))
    else:
        arr = json_scalar_array(c)
    return F.coalesce(clean_list(arr), empty_list())


def size_or_null(arr) -> Column:
    """Element count, NULL for a NULL list whatever ``sizeOfNull`` says."""
    a = col_of(arr)
    return F.when(a.isNotNull(), F.size(a))


def skills_text(arr, sep: str = "|") -> Column:
    """Engine-neutral text form of a list (NULL stays NULL)."""
    return F.array_join(col_of(arr), sep)


# ----------------------------------------------------------------------------
# Taxonomy extraction
# ----------------------------------------------------------------------------

_REGEX_SPECIAL = set(".^$*+?()[]{}|\\")


def regex_escape(s: str) -> str:
    """Escape Java-regex metacharacters so ``s`` matches literally."""
    return "".join("\\" + ch if ch in _REGEX_SPECIAL else ch for ch in s)


def default_taxonomy() -> list[tuple[str, str]]:
    """(pattern, canonical name) pairs of the built-in taxonomy."""
    return [(p, SKILL_ALIASES.get(p.lower(), p.title())) for p in SKILL_PATTERNS]


def taxonomy_groups(taxonomy=None) -> list[tuple[str, list[str]]]:
    """Canonical name -> its patterns, canonical names in first-seen order."""
    groups: dict[str, list[str]] = {}
    for pattern, canon in taxonomy or default_taxonomy():
        groups.setdefault(canon, []).append(pattern)
    return list(groups.items())


def taxonomy_regex(patterns: list[str]) -> str:
    """One Java regex that finds any of the patterns as a whole word.

    ``(?U)`` keeps ``\\b`` Unicode-aware (as in Python) on every JDK.  Each
    alternative is tried at every position, so this equals testing the
    patterns one by one.  The text it runs on is already lowercased and the
    patterns are lowercase, so no case-insensitive flag is needed.
    """
    alts = "|".join(regex_escape(p.lower()) for p in patterns)
    return rf"(?U)\b(?:{alts})\b"


def extraction_text(title, description) -> Column:
    """Lowercased 'title description' of the non-blank parts ('' if none)."""
    return F.lower(F.concat_ws(" ", blank_to_null(title), blank_to_null(description)))


def taxonomy_hits(text, taxonomy=None) -> Column:
    """Sorted, distinct canonical names whose patterns occur in ``text``
    (already lowercased) as whole words.

    Every name is tested independently, so overlapping phrases all count
    ("google cloud storage" gives GCP and Cloud Storage).  A plain substring
    test guards each regex, so the regex only runs on rows that can match.
    Names are emitted in code-point order (Python's ``sorted``) and NULLs are
    removed with ``array_except``; no lambda is involved, so the whole
    expression stays in generated code and ``text`` is computed once.
    """
    text = col_of(text)
    groups = sorted(taxonomy_groups(taxonomy), key=lambda g: g[0])
    hits = []
    for canon, pats in groups:
        guard = reduce(lambda a, b: a | b, [text.contains(p.lower()) for p in pats])
        hits.append(F.when(guard & text.rlike(taxonomy_regex(pats)), F.lit(canon)))
    return F.array_except(F.array(*hits), F.array(F.lit(None).cast("string")))


def extract_taxonomy(title, description, taxonomy=None) -> Column:
    """Sorted, distinct canonical skill names found in title + description."""
    return taxonomy_hits(extraction_text(title, description), taxonomy)


def with_taxonomy(df, title="job_title", description="job_description", out: str = "skills_taxonomy",
                  taxonomy=None):
    """DataFrame form: the lowercased text is projected once, then matched."""
    tmp = f"_{out}_text"
    return (df.withColumn(tmp, extraction_text(title, description))
              .withColumn(out, taxonomy_hits(tmp, taxonomy)).drop(tmp))


# ----------------------------------------------------------------------------
# Set metrics and merges
# ----------------------------------------------------------------------------

def _skill_set(arr) -> Column:
    norm = F.transform(F.coalesce(col_of(arr), empty_list()), lambda x: F.lower(trim_ws(x)))
    return F.array_distinct(F.filter(norm, lambda x: x != F.lit("")))


def jaccard(a, b) -> Column:
    """|A ∩ B| / |A ∪ B| of trimmed, lowercased, non-blank items.

    Both empty -> 1.0, exactly one empty -> 0.0.
    """
    sa, sb = _skill_set(a), _skill_set(b)
    na, nb = F.size(sa), F.size(sb)
    ratio = F.size(F.array_intersect(sa, sb)).cast("double") / F.size(F.array_union(sa, sb))
    return (F.when((na == 0) & (nb == 0), F.lit(1.0))
            .when((na == 0) | (nb == 0), F.lit(0.0))
            .otherwise(ratio))


def merge_skills(given, extracted) -> Column:
    """Given skills followed by new extracted ones, first occurrence wins.

    Empty/NULL given -> extracted; nothing extracted -> given as is (repeats
    kept); both empty -> NULL.
    """
    g, e = col_of(given), F.coalesce(col_of(extracted), empty_list())
    g_empty = g.isNull() | (F.size(g) == 0)
    merged = (F.when(g_empty, e).when(F.size(e) == 0, g)
               .otherwise(F.array_distinct(F.concat(g, e))))
    return F.when(F.size(merged) > 0, merged)


def hybrid_skills(primary, fallback) -> Column:
    """Primary list where it has items, otherwise the fallback list."""
    p = col_of(primary)
    return F.when(p.isNotNull() & (F.size(p) > 0), p).otherwise(col_of(fallback))


# ----------------------------------------------------------------------------
# Parsing skill lists from source text
# ----------------------------------------------------------------------------

def skill_list_single(c) -> Column:
    """Rule (a): one trimmed element, NULL when blank."""
    t = blank_to_null(c)
    return F.when(t.isNotNull(), F.array(t))


def skill_list_from_array(c) -> Column:
    """Rule (a) for list input: trimmed non-blank items, NULL when none."""
    lst = clean_list(F.transform(col_of(c), lambda x: x.cast("string")))
    return F.when(F.size(lst) > 0, lst)


def skill_list_bracketed(c) -> Column:
    """Rule (b): text that starts with '[' or holds ';' or '|' is split on
    ';' and '|' with brackets removed (commas are kept inside items);
    separators only -> []; other text -> one trimmed item or NULL."""
    s = col_of(c)
    listy = s.startswith("[") | s.contains(";") | s.contains("|")
    parts = F.split(F.regexp_replace(s, r"[\[\]]", ""), r"[;|]", -1)
    return F.when(listy, clean_list(parts)).otherwise(skill_list_single(s))


def skill_list_separated(c) -> Column:
    """Rule (c): text holding ';', '|' or ',' is split on all three;
    separators only -> []; other text -> one trimmed item or NULL."""
    s = col_of(c)
    listy = s.contains(";") | s.contains("|") | s.contains(",")
    parts = F.split(s, r"[;|,]", -1)
    return F.when(listy, clean_list(parts)).otherwise(skill_list_single(s))


def skills_blob_text(c, dtype: DataType | None = None) -> Column:
    """Free-text skills field -> description text: trimmed string, or the
    list's non-blank items joined by newlines; NULL when nothing is left."""
    c = col_of(c)
    if isinstance(dtype, ArrayType):
        lst = clean_list(F.transform(c, lambda x: x.cast("string")))
        return F.when(F.size(lst) > 0, F.array_join(lst, "\n"))
    return blank_to_null(c.cast("string"))


_FENCE_OPEN = r"^```[^\n]*+(?:\n|$)"
_FENCE_CLOSE = r"\n[ \t\r\f\x0b]*+```[ \t\r\f\x0b]*+$"


def _reply_item(x) -> Column:
    """Text of one item of a reply, NULL for the falsy ones: null, false, zero, '', {} and [].
    True is 'True'; objects and lists are their JSON text."""
    def plain(kind, text):
        number = kind.startswith("DECIMAL") | kind.isin("BIGINT", "DOUBLE", "FLOAT")
        return (F.when(kind == "STRING", text)
                 .when(kind == "VOID", F.lit(None))
                 .when(kind == "BOOLEAN", F.when(text == "true", "True"))
                 .when(number, F.when(text.try_cast("double") != 0, text))
                 .otherwise(F.when(~text.isin("{}", "[]"), text)))

    return once(F.struct(F.schema_of_variant(x).alias("kind"), x.cast("string").alias("text")), lambda v: plain(v["kind"], v["text"]))


def json_items(text) -> Column:
    """``array<variant>`` of the items of a JSON array, NULL for anything else.

    The JSON reader stops behind the first value, so the text is read inside an
    array and inside an object: text after it is an error in one of the two.
    """
    def whole(t, outer):
        inside = F.try_parse_json(F.concat(F.lit('{"v":'), t, F.lit("}")))
        return F.when((F.size(outer) == 1) & inside.isNotNull(), outer[0].cast("array<variant>"))

    def items(t):
        outer = F.try_parse_json(F.concat(F.lit("["), t, F.lit("]"))).cast("array<variant>")
        return F.when(t.startswith("["), once(outer, lambda o: whole(t, o)))

    return once(trim_ws(text), items)


def parse_response_skills(c) -> Column:
    """Model reply text -> skill list.

    The reply is trimmed; a leading markdown fence line is dropped, and so is
    a closing fence line; the rest must be a JSON array, else [].  Falsy items
    are dropped, the others become text (see ``_reply_item``)."""
    body = once(trim_ws(c), lambda s: F.when(s.startswith("```"), F.regexp_replace(F.regexp_replace(s, _FENCE_CLOSE, ""), _FENCE_OPEN, ""))
                .otherwise(s))
    return F.coalesce(clean_list(F.transform(json_items(body), _reply_item)), empty_list())
