"""Hosts and manifest links."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: scheme (optional), two slashes, then the authority up to the first / ? or #.
AUTHORITY = r"^(?:[A-Za-z][A-Za-z0-9+.-]*:)?//([^/?#]*)"


def host_of(url: Column) -> Column:
    """Authority up to its first colon; case is kept and user info is not taken off.

    ``parse_url(.., 'HOST')`` differs for user info, bracketed addresses and ``_`` in names.
    """
    return F.split_part(F.regexp_extract(url, AUTHORITY, 1), F.lit(":"), F.lit(1))


def is_manifest_link(url: Column) -> Column:
    return url.contains("/manifest") | url.endswith(".json")
