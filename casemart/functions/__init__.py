"""Column expressions shared by the operators; all of them stay in the JVM."""
