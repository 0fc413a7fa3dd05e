"""Column expressions: every scalar rule of the engine, JVM-side."""
