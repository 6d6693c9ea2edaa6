"""quire package."""
