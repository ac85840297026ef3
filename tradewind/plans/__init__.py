"""Star schema, KPI, analytics and dashboard plans."""
