"""Column expressions; all built-in functions, evaluated in the JVM."""
