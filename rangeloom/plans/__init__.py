"""Load specs, range plans and session settings."""
