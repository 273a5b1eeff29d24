"""Part of the shelfspark package."""
