"""cohortlake: cohort selection and imaging-dataset preparation on Spark.

Every operator takes and returns DataFrames and is built from Spark SQL
expressions; Python runs inside tasks only where file contents are decoded.
"""

from cohortlake.session import get_spark, shared_dir

__all__ = ["get_spark", "shared_dir"]
