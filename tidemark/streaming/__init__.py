"""File sources that remember what they have read."""
