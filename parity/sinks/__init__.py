"""Sinks: control/result tables and their history."""
