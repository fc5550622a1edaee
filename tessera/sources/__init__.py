"""Tables of a knowledge base as Parquet, and other formats in and out."""
