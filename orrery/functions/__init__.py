"""Column -> Column functions. Everything here is a native Spark
expression (no Python UDF), so it stays inside whole-stage codegen."""
