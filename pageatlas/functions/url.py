"""URL scalars."""

from pyspark.sql import Column
from pyspark.sql import functions as F


def base_url(url: Column) -> Column:
    """The url without its fragment."""
    return F.substring_index(url, "#", 1)


def authority(url: Column) -> Column:
    """What stands between the scheme and the path; empty for anything that is no url."""
    return F.regexp_extract(url, r"^[A-Za-z][A-Za-z0-9+.-]*://([^/?#]*)", 1)


def host(url: Column) -> Column:
    """Host in lower case, without user and port."""
    return F.lower(F.regexp_extract(authority(url), r"^(?:.*@)?(\[[^\]]*\]|[^:]*)", 1))


def url_key(url: Column) -> Column:
    return F.sha1(url)


def raw_object_key(url: Column, content_hash: Column) -> Column:
    key = url_key(url)
    return F.concat_ws("/", F.lit("raw"), F.substring(key, 1, 2), key, F.substring(content_hash, 1, 16))
