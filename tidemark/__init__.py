"""Event-time and sales-KPI analytics as PySpark DataFrame functions."""
