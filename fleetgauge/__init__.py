"""Multi-tenant sensor analytics as plain PySpark DataFrame operators."""
