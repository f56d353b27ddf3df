"""Structured Streaming jobs: settling, mirroring and scheduled refresh."""
