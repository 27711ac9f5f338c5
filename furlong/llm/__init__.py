"""Operators for training-data pipelines: thirteen operators, their queries, nothing the rest of the library needs."""
