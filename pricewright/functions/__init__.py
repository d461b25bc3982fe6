"""Column expressions; nothing here starts a Spark job."""
