"""Composite analyses, fixture bindings, the query registry and its SQL oracle."""
