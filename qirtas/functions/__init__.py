"""Column -> Column expressions; all run in the JVM without Python workers."""
