"""Spark-native analytics for aircraft telemetry and smart-meter readings."""
