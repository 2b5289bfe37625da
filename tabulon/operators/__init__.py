"""Relational operators: DataFrame in, DataFrame out; nothing here collects."""
