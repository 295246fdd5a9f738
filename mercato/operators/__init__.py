"""DataFrame operators: upsert, history, ranking, quality, profiling, filters."""
