"""The operators over streams."""
