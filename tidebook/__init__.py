"""tidebook: business KPIs, segments and cohorts as plain Spark DataFrame jobs."""

__version__ = "0.1.0"
