"""Single-step DataFrame operators."""
