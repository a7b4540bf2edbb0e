"""The row-wise part of the cleaning chain on streams."""
