"""DataFrame operators: projection, filters, imputation, duplicates, KPIs, latest rows."""
