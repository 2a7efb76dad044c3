"""Staging loads, fact loads, dashboard questions and the load that runs them on storage."""
