"""Questions asked of the log, alert and score tables."""
