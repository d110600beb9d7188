"""Compositions of operators: SQL models, serving queries, audit figures and the nightly batch."""
