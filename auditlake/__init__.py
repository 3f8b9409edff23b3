"""auditlake: audit-report analytics on Spark DataFrames."""
