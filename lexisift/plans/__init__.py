"""Registered queries: each pairs a Spark plan with its SQL equivalent."""
