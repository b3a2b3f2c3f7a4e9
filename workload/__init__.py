"""Checked queries over the given tables: the callables and their SQL counterparts."""
