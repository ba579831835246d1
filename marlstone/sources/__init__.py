"""Readers with their schemas, and the delimited-text sink."""
