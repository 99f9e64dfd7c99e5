"""Reports, scheduled jobs, the registered query catalog and its DuckDB oracle."""
