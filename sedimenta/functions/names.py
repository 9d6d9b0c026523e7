"""Column-name functions."""

from __future__ import annotations

import re

from pyspark.sql import Column
from pyspark.sql import functions as F


def norm_name(name: Column | str) -> Column:
    """Lower-case ``name`` and keep letters a-z and digits only.

    A name without any of them, as in other scripts, stays itself in lower case, so that such names
    do not all become one.
    """
    column = F.col(name) if isinstance(name, str) else name
    kept = F.regexp_replace(F.lower(column), "[^a-z0-9]", "")
    return F.when(kept == "", F.lower(F.trim(column))).otherwise(kept)


def norm_text(name: str) -> str:
    """``norm_name`` for a configured Python string."""
    return re.sub("[^a-z0-9]", "", name.lower()) or name.strip(" ").lower()
