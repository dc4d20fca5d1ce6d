"""River-drainage datasets on Spark: checks, compilation, queries and data-quality operators."""
