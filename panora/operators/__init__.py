"""DataFrame -> DataFrame operators: joins, aggregation, windows, reshape,
profiling, panel design and estimators."""
