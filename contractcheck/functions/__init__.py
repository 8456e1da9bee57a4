"""Column-level helpers; everything here stays inside Spark's own expressions
except the two small text helpers in :mod:`contractcheck.functions.text`."""
