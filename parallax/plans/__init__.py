"""parallax.plans."""
