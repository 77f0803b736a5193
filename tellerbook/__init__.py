"""Transaction analytics on PySpark: events to bronze, silver and gold."""
