"""martloom: commercial-analytics operators and reports as plain Spark DataFrame code."""
