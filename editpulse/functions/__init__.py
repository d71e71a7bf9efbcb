"""Column expressions. All run inside the JVM; there are no Python UDFs."""
