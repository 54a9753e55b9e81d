"""Jobs: functions from DataFrames and options to DataFrames."""
