"""DataFrame operators shared by all plans."""
