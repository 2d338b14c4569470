"""Where logs come from."""
