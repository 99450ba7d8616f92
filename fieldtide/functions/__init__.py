"""Column expressions: text, dates, rules. All run inside the JVM, none is a Python UDF."""
