"""Query catalog (Spark side and DuckDB oracle side), batch jobs and plan checks."""
