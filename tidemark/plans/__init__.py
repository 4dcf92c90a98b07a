"""Jobs over lists of tables."""
