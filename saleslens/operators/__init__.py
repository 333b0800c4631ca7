"""Building blocks: functions from DataFrame to DataFrame with explicit columns."""
