"""Column expressions: keys, calendars, masks, text."""
