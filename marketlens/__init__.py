"""Commodity market analytics as plain PySpark DataFrame functions.

Nothing here holds a session or global state: every operator takes DataFrames
and parameters and returns a lazy DataFrame.
"""
