"""tidemark: change data and event-time analytics as plain PySpark DataFrame jobs."""
