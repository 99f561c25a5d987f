"""tidewater.sources."""
