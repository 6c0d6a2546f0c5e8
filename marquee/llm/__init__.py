"""Operators for preparing training data: ten dealt operators, their queries, and helpers."""
