"""URL host extraction (U5) as a JVM-side column expression."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from cohortline.functions.memo import column_memo

# Fixed value: the host pattern. Optional leading blanks, optional scheme
# (``name:`` followed by ``//``, or a bare ``//``), optional userinfo ending
# in ``@``, then the host: a bracketed IPv6 literal or everything up to the
# first ``/ ? # :`` or blank. Case is kept. ``try_parse_url`` is not used: it
# returns null for scheme-less referrers such as ``www.site.com/x`` and for
# hosts with underscores, both of which occur in referrer logs.
HOST_PATTERN = r"^\s*(?:(?:[A-Za-z][A-Za-z0-9+.-]*:)?//)?(?:[^/?#@\s]*@)?(\[[^\]]*\]|[^/?#:\s]*)"


@column_memo
def url_host(url: Column | str) -> Column:
    """Host part of ``url``; null for null input and when nothing is found."""
    col = F.col(url) if isinstance(url, str) else url
    return F.nullif(F.regexp_extract(col, HOST_PATTERN, 1), F.lit(""))
