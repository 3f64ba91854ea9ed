"""Online-store analytics as PySpark DataFrame jobs."""
