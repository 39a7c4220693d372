"""Column functions shared by the operators; all of them are JVM-side built-ins."""
