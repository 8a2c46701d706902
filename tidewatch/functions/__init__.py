"""Column-level building blocks (all evaluated inside the JVM)."""
