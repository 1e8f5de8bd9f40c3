"""DataFrame-level operators composed from built-in joins, aggregates and windows."""
