"""Point-in-time analytics for two-competitor bouts, written for Spark."""
