"""tidewater.plans."""
