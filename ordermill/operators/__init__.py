"""Reusable DataFrame operators: staging, keyed writes, checks, sampling."""
