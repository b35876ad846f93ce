"""One builder per warehouse table."""
