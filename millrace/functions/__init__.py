"""Column-level building blocks: functions from Column (or column names) to Column."""
