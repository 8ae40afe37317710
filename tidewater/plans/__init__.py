"""Composite CDC flows built from the operators: registry ingest, the
structured upsert of a micro-batch, counts and database publishing."""
