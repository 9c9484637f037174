"""Column helpers: row-local expressions, evaluated inside the JVM."""
