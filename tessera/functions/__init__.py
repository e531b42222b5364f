"""Column expressions (pure JVM builtins, no Python UDFs)."""
