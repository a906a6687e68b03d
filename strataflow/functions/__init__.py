"""Column functions: text parsing, bands and calendars."""
