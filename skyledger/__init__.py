"""Layered analytics over scheduled operations, written as Spark DataFrame programs."""
