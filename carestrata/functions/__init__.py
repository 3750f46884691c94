"""Column expressions. Everything here stays inside generated JVM code."""
