"""Column expressions shared by the jobs; all of them stay inside the JVM."""
