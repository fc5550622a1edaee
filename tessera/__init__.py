"""Tessera: graph-and-vector retrieval over text knowledge bases, as PySpark DataFrame plans."""
