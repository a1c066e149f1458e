"""DataFrame and Structured Streaming operators over a business event log."""
