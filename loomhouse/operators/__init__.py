"""Relational operators: version building, interval joins, keys, sinks, aggregates."""
