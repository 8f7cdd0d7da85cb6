"""Operators that prepare text and records for model training.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its queries only if it can be imported.
"""
