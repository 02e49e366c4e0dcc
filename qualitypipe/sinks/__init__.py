"""File writes and previews."""
