"""Mass-appraisal analytics as plain Spark DataFrame operators."""
