"""Custom DataFrame operators Spark lacks as one call."""
