"""Relational, graph and vector operators over knowledge-base tables."""
