"""Column helpers; all of them stay in the JVM."""
