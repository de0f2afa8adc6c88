"""Column expressions (JVM-side built-ins only) used by the operators."""
