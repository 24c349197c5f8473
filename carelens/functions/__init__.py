"""Column helpers and the fixed rule tables."""
