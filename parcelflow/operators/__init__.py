"""Relational operators used by the models: window dedups and pairing,
aggregates, key joins, SCD2 and data tests."""
