"""Cadenza: episode and sensor-log analytics as DataFrame functions on Spark."""
