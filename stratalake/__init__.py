"""Layered (Bronze / Silver / Gold) retail and fleet analytics as Spark DataFrame plans."""
