"""parallax.functions."""
