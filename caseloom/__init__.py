"""Business-case analytics as plain ``DataFrame -> DataFrame`` functions on Spark."""
