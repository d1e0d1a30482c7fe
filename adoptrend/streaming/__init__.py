"""The activity counts kept up to date from a growing log."""
