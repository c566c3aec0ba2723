"""Grant and bibliometrics analytics as Spark jobs."""
