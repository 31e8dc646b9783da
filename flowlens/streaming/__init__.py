"""Micro-batch scoring, batch summaries and service-level tracking."""
