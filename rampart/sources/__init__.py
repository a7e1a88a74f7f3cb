"""Where lines and events come from, in batch and as streams."""
