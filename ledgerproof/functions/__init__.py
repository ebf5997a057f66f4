"""Column functions: everything here returns a Spark Column and stays in the JVM."""
