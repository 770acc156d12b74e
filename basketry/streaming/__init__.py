"""The clickstream preparation as a Structured Streaming job."""
