"""Column-level helpers: all built from ``pyspark.sql.functions`` so they
stay inside whole-stage codegen."""
