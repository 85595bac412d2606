"""Column builders: scalar rules expressed as JVM-side Spark expressions."""
