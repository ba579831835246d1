"""The registered queries: each operator over the given tables, beside equivalent SQL."""
