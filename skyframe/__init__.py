"""skyframe: flight-position and flight-delay analytics as PySpark jobs."""
