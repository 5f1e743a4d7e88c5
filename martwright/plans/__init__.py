"""Data marts and layer loads: functions from DataFrames to DataFrames."""
