"""Addresses as columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_PARTS = r"^([a-zA-Z][a-zA-Z0-9+.\-]*)://(?:[^/?#@]*@)?([^/?#:]*)(?::(\d*))?([^?#]*)(\?[^#]*)?"


def _part(url: Column, group: int) -> Column:
    return F.regexp_extract(url, _PARTS, group)


def host_of(url: Column) -> Column:
    return F.lower(_part(url, 2))


def normalize_url(url: Column) -> Column:
    """Host, port, path and query; the scheme, the fragment and one trailing slash are dropped."""
    scheme, port, path, search = F.lower(_part(url, 1)), _part(url, 3), _part(url, 4), _part(url, 5)
    default = ((scheme == "http") & (port == "80")) | ((scheme == "https") & (port == "443")) | (port == "")
    full = F.concat(
        host_of(url),
        F.when(default, F.lit("")).otherwise(F.concat(F.lit(":"), port)),
        F.when(path == "", F.lit("/")).otherwise(path),
        F.when(search == "?", F.lit("")).otherwise(search),
    )
    return F.regexp_replace(full, "/$", "")
