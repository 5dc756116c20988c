"""Observability and cost analytics of AI-agent fleets as PySpark jobs."""
