"""Message formatting / parsing shared by batch and Structured Streaming."""
