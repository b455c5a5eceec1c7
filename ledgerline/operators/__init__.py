"""Relational operators on DataFrames: rules, deduplication, checks, components, bridges, measures."""
