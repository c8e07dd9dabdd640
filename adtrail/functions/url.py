"""URL column expressions (native, ANSI-safe).

``try_parse_url`` / ``try_url_decode`` return NULL where the plain forms
raise under ANSI mode, so one dirty log line never fails a day's job.
A missing query key gives NULL, ``k=`` gives ``''``.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from adtrail.fixed import MAX_EVENT_TIME_MS, URL_PREFIX


def _col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def absolute_url(uri, prefix: str = URL_PREFIX) -> Column:
    """Prefix a path+query with a dummy scheme and host."""
    return F.concat(F.lit(prefix), _col(uri))


def query_param(url, key: str) -> Column:
    """Value of ``key`` in the query string (first occurrence)."""
    return F.try_parse_url(_col(url), F.lit("QUERY"), F.lit(key))


def url_part(url, part: str) -> Column:
    """``HOST``, ``PATH``, ``QUERY``, ``REF``, ``PROTOCOL``, ``FILE``, ``AUTHORITY``, ``USERINFO``."""
    return F.try_parse_url(_col(url), F.lit(part))


def query_pairs(query) -> Column:
    """An extracted query string as its ``key=value`` pairs (split once, for
    every key that is read from it)."""
    return F.split(_col(query), "&")


def pair_value(pairs, key: str) -> Column:
    """Value of ``key`` in :func:`query_pairs`, with the same rule as
    ``parse_url(u, 'QUERY', key)``: first ``(&|^)key=([^&]*)``; NULL when the
    key is absent (or the query is NULL)."""
    first = F.get(F.filter(_col(pairs), lambda p: p.startswith(f"{key}=")), 0)
    return F.substring(first, len(key) + 2, 2 ** 31 - 1)


def split_element(path, index: int) -> Column:
    """Element ``index`` of an extracted path split on ``/``; NULL when shorter."""
    return F.get(F.split(_col(path), "/"), index)


def path_element(url, index: int) -> Column:
    """Element ``index`` of the path split on ``/`` (0 is the empty string
    before the leading slash); NULL when the path is shorter."""
    return F.get(F.split(url_part(url, "PATH"), "/"), index)


def decode(value) -> Column:
    """URL-decode (``+`` becomes a space, like ``java.net.URLDecoder``); NULL on bad escapes."""
    return F.try_url_decode(_col(value))


def to_bigint(value) -> Column:
    """String to bigint, NULL when not a number."""
    return _col(value).try_cast("bigint")


def valid_event_time(t) -> Column:
    """Epoch ms within the valid domain; NULL outside it, as for a non-number.
    (``t`` comes from the client: without a domain, differences of two times
    could overflow and fail the day.)"""
    c = _col(t)
    return F.when((c >= 0) & (c < MAX_EVENT_TIME_MS), c)
