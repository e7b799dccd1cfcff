"""Named SQL queries over the canonical ``events`` view."""
