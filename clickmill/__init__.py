"""Clickstream lakehouse marts as plain Spark DataFrame functions."""
