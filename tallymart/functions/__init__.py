"""Column helpers: exact money arithmetic and scoring expressions."""
