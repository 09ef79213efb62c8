"""Where records and dimensions come from."""
