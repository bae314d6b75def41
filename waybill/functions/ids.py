"""Record ids carried inside resource URLs."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Last path segment made of id characters, with an optional file extension. The extensions.
_LAST_ID = r"^(?:.*/)?([A-Za-z0-9_-]+)(?:\.(?:json|xml|html))?(?:/.*)?$"


def id_from_url(url: Column) -> Column:
    """Id of a resource URL: the last path segment that looks like an id, ``""`` when there is none.

    Query, fragment, scheme and host are no part of the path. A segment that is no id (``a.b.c``) is passed over for the
    one before it. One regular expression per step, so the projection keeps its generated code (array lambdas lose it).
    """
    path = F.regexp_replace(F.trim(url), r"[?#].*$", "")
    path = F.regexp_replace(path, r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?(?://[^/]*)?", "")
    path = F.regexp_replace(path, r";[^/]*$", "")
    return F.coalesce(F.regexp_extract(path, _LAST_ID, 1), F.lit(""))


def optional_id_from_url(url: Column) -> Column:
    """Like ``id_from_url`` but NULL instead of ``""``, for links a record may lack."""
    return F.nullif(id_from_url(url), F.lit(""))
