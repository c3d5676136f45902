"""Column functions: text, JSON, key/value and XML helpers that stay inside the JVM."""
