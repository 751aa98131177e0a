"""Retail and campaign analytics as plain PySpark DataFrame functions.

Every dataset function takes ``tables`` (a mapping of canonical table name to
DataFrame) and returns a lazy DataFrame.  Anything that depends on "now" takes
an explicit ``as_of``; ``None`` means the session's local clock.
"""
