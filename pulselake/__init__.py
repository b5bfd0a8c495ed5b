"""Wearable and health-app analytics as plain Spark DataFrame operators."""
