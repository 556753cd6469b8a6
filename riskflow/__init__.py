"""Binary-risk scoring on Spark tables and streams.

The package is a set of DataFrame-to-DataFrame operators.  Library code takes
the caller's session as it finds it: it never picks a master and never changes
a session setting.
"""
