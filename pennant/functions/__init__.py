"""Column-expression builders (JVM-side, whole-stage codegen; no Python UDFs)."""
