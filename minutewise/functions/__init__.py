"""Column builders (pure expressions, JVM-side, codegen-friendly)."""
