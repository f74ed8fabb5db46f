"""Column expressions: every function returns a ``Column`` evaluated JVM-side."""
