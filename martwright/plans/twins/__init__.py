"""SQL twins of the registered queries, for checking on another engine.

They state each result the plain way (row numbers over whole tables, one wide
join of facts and dimensions) and share no code with the Spark operators.
"""

from .statements import TWIN_SQL

__all__ = ["TWIN_SQL"]
