"""Change streams."""
