"""Column and join helpers shared by the operators; all stay inside the JVM."""
