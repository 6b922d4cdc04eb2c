"""Column expressions. Built-in functions only: all of it stays in the JVM."""
