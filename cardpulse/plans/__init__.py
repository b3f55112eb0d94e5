"""Compositions of operators: feature tables, training sets, scoring, and the catalog of named queries."""
