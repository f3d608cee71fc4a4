"""parallax.streaming."""
