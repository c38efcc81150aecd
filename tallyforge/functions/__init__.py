"""Column functions. All compose built-in expressions, so Catalyst sees through them."""
