"""parallax.operators."""
