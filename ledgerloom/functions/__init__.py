"""Column-level helpers built only from JVM-side Spark functions."""
