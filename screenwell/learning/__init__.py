"""Severity and text models on Spark ML."""
