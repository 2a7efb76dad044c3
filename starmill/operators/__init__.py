"""Keys, versioned dimensions, lookups, calendars and audits."""
