"""Column-expression helpers shared by the operators (all JVM-side built-ins)."""
