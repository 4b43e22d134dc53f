"""Column expressions.  Every function here returns a ``pyspark.sql.Column``."""
from hirelake.functions.text import blank_to_null, trim_ws, col_of  # noqa: F401
