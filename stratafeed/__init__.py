"""Layered (raw, bronze, silver) processing of event feeds on PySpark."""
