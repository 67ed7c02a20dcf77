"""Multi-tenant retail analytics as composable PySpark DataFrame jobs."""
