"""parallax.sources."""
