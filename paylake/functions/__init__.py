"""Small column expressions shared by the operators. All run JVM-side."""
