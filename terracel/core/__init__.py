"""Building blocks shared by all operators."""
