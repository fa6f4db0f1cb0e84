"""Flight, airport and weather analytics written as PySpark DataFrame jobs."""
