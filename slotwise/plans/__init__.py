"""End-to-end compositions."""
