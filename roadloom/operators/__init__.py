"""Part of roadloom."""
