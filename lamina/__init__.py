"""Layered (raw / clean / published) analytics on plain PySpark."""
