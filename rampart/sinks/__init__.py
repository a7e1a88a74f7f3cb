"""Where events go."""
