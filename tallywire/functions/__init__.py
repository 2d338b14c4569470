"""Column functions: numbers, text, time and strict JSON. All of them stay inside Spark's expressions."""
