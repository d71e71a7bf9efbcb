"""Structured Streaming jobs: landing, live marts, publishing, marks."""
