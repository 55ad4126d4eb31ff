"""Operators for large-scale training-data pipelines (imported by nothing else in the library)."""
