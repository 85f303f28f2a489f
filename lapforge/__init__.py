"""lapforge: timing and telemetry analytics as lazy Spark DataFrame jobs.

Every public function takes DataFrames (or Columns) and returns DataFrames (or
Columns).  Nothing is collected to the driver and no Python runs per row.
"""
