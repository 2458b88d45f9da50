"""Conversation and application telemetry analytics as plain PySpark DataFrame functions."""
