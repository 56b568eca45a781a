"""Spark jobs for layered, change-fed tables."""
