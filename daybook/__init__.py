"""daybook: accounting ETL and analytics as plain Spark DataFrame functions.

Every public function takes DataFrames (and plan-time parameters) and returns a
DataFrame; the caller owns the session and triggers the actions.
"""
