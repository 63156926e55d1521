"""Column expressions. Everything here is built-in Spark SQL; nothing leaves the JVM."""
