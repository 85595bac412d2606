"""Composite plans: the batch mart job, the detections-to-violations job, and
the dashboard's query set."""
