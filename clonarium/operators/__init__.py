"""DataFrame operators: joins, intervals, trees, reshaping, aggregates, checks."""
