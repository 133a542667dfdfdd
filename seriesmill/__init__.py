"""Sales analytics and many-series forecasting, written as PySpark DataFrame jobs."""
