"""Behavioural features, inactivity models and decision analysis on Spark."""
