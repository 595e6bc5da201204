"""Row and table operators: duplicates, nulls, joins, KPI aggregation, quality checks."""
