"""Bronze, silver and gold tables on plain open-source Spark."""
