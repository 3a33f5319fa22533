"""Event, queue and log analytics as Spark DataFrame operators."""
