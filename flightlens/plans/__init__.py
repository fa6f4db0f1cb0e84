"""The reports: functions from input frames to a lazy result frame."""
