"""Fixed values that results depend on.

These lists must stay exactly as they are for results to match the original
pipeline: the domain keywords (matched as plain substrings, trailing spaces
included), the exact short titles, and the skills taxonomy with its aliases.
They are kept here as plain text, in their original order.
"""
from __future__ import annotations

# ---- fixed values: data-domain keywords (substring match on lowercased text) ----
DOMAIN_KEYWORDS: list[str] = [
    "data engineer",
    "data engineering",
    "data science",
    "data scientist",
    "big data",
    "machine learning",
    "ml engineer",
    "ai ",
    "artificial intelligence",
    "analytics",
    "data analyst",
    "business intelligence",
    "bi ",
    "etl",
    "data pipeline",
    "data warehouse",
    "data lake",
]

# ---- fixed values: short job titles that are data-domain on their own ----
DOMAIN_JOB_TITLES: list[str] = [
    "Data Engineer",
    "Data Scientist",
    "Data Analyst",
    "Analytics Engineer",
    "Business Analyst",
    "Machine Learning Engineer",
]

# ---- fixed values: skills taxonomy patterns (whole-word, case-insensitive) ----
SKILL_PATTERNS: list[str] = [
    "apache spark",
    "apache kafka",
    "apache airflow",
    "google cloud",
    "google cloud platform",
    "machine learning",
    "data pipeline",
    "data warehouse",
    "data lake",
    "data modeling",
    "etl",
    "elt",
    "python",
    "python3",
    "sql",
    "spark",
    "pyspark",
    "kafka",
    "airflow",
    "aws",
    "gcp",
    "azure",
    "snowflake",
    "redshift",
    "bigquery",
    "databricks",
    "dbt",
    "terraform",
    "docker",
    "kubernetes",
    "k8s",
    "java",
    "scala",
    "pandas",
    "numpy",
    "tableau",
    "looker",
    "power bi",
    "dbt core",
    "fivetran",
    "talend",
    "informatica",
    "postgresql",
    "postgres",
    "mysql",
    "mongodb",
    "redis",
    "elasticsearch",
    "hadoop",
    "hive",
    "presto",
    "trino",
    "beam",
    "dataflow",
    "cloud storage",
    "pub/sub",
    "bigtable",
    "firestore",
    "dataform",
    "dbt cloud",
    "great expectations",
    "dagster",
    "prefect",
]

# ---- fixed values: pattern -> canonical name (patterns not listed use str.title()) ----
SKILL_ALIASES: dict[str, str] = {
    "pyspark": "Spark",
    "apache spark": "Spark",
    "spark": "Spark",
    "apache kafka": "Kafka",
    "kafka": "Kafka",
    "apache airflow": "Airflow",
    "airflow": "Airflow",
    "google cloud": "GCP",
    "google cloud platform": "GCP",
    "gcp": "GCP",
    "aws": "AWS",
    "azure": "Azure",
    "snowflake": "Snowflake",
    "redshift": "Redshift",
    "bigquery": "BigQuery",
    "databricks": "Databricks",
    "dbt": "dbt",
    "dbt core": "dbt",
    "dbt cloud": "dbt",
    "terraform": "Terraform",
    "docker": "Docker",
    "kubernetes": "Kubernetes",
    "k8s": "Kubernetes",
    "python": "Python",
    "python3": "Python",
    "sql": "SQL",
    "java": "Java",
    "scala": "Scala",
    "etl": "ETL",
    "elt": "ELT",
    "machine learning": "Machine Learning",
    "data pipeline": "Data Pipeline",
    "data warehouse": "Data Warehouse",
    "data lake": "Data Lake",
    "data modeling": "Data Modeling",
    "pandas": "Pandas",
    "numpy": "NumPy",
    "tableau": "Tableau",
    "looker": "Looker",
    "power bi": "Power BI",
    "postgresql": "PostgreSQL",
    "postgres": "PostgreSQL",
    "mysql": "MySQL",
    "mongodb": "MongoDB",
    "redis": "Redis",
    "elasticsearch": "Elasticsearch",
    "hadoop": "Hadoop",
    "hive": "Hive",
    "presto": "Presto",
    "trino": "Trino",
    "beam": "Beam",
    "dataflow": "Dataflow",
    "fivetran": "Fivetran",
    "talend": "Talend",
    "informatica": "Informatica",
    "great expectations": "Great Expectations",
    "dagster": "Dagster",
    "prefect": "Prefect",
}

# ---- fixed values: characters Python's str.strip() removes (str.isspace) ----
WHITESPACE: str = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f\x20\x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# ---- fixed values: default posted dates of the three file sources ----
DEFAULT_DATE_DE_2023 = "2023-04-01"
DEFAULT_DATE_LINKEDIN_POSTINGS = "2023-06-01"
DEFAULT_DATE_LINKEDIN_SKILLS = "2024-01-01"

# ---- fixed values: recency window, canned-query bounds, sizes ----
RECENT_DAYS = 3 * 365
TOP_SKILLS_DEFAULT, TOP_SKILLS_MIN, TOP_SKILLS_MAX = 15, 1, 100
RECENT_MONTHS_DEFAULT, RECENT_MONTHS_MIN, RECENT_MONTHS_MAX = 6, 1, 36
BROWSE_DEFAULT, BROWSE_MIN, BROWSE_MAX = 200, 50, 2000
PREVIEW_CHARS = 400
SNIPPET_CHARS = 200
COMPARE_SAMPLE = 300
ENRICH_BATCH = 10

# ---- fixed values: cell texts a pandas CSV read turns into missing values ----
CSV_NA_VALUES: list[str] = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
]

# ---- fixed values: column maps of the 2023 data-engineer CSV ----
DE_EXACT_COLUMNS: dict[str, str] = {
    "Job_details": "job_title",
    "Job_details.1": "job_description",
    "Company_info": "company_name",
    "Job_details.4": "location_city",
    "Job_details.5": "location_state",
    "Job_details.6": "location_country",
    "Salary.2": "salary_avg",
    "Salary.3": "salary_currency",
}
DE_NORMALIZED_COLUMNS: dict[str, str] = {
    "job_title": "job_title",
    "title": "job_title",
    "description": "job_description",
    "desc": "job_description",
    "location": "location",
    "company_name": "company_name",
    "company": "company_name",
    "salary": "salary_info",
}
