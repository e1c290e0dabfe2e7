"""Operators and queries for preparing training text.

Nothing outside this subpackage imports it; ``__spark_entry__`` adds its
queries when it is present."""
