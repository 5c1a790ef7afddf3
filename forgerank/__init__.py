"""forgerank: contribution analytics as Spark DataFrame jobs.

Every public function takes and returns DataFrames. Reference-time values
(``as_of``) are passed in explicitly; nothing reads the wall clock inside a
tested query.
"""

__all__ = ["session"]
