"""Consumer-credit portfolio analytics as plain Spark DataFrame functions."""
