"""Event lakehouse on Spark: raw event files to bronze, silver and gold tables.

Every transformation takes and returns a DataFrame and starts no session.
"""
