"""Column to Column building blocks: built-in Spark functions only."""
