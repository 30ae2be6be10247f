"""Structured Streaming job (J1) and its replay harness."""
