"""Table operators. Each takes DataFrames or Collections and returns DataFrames."""
