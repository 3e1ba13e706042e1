"""Results over time, kept up to date by Structured Streaming."""
