"""Column expressions that take addresses apart."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

# A scheme needs a colon after at least one character and a slash right behind it.
SCHEME = r"^([^:/]+):/"
# An authority follows two slashes, but not if they end the text.
AUTHORITY = r"^(?:[^:/]+:(?=/))?//([^/]+)"
BEFORE_PATH = r"(?s)^([^:/]+:(?=/))?(//(?=.)[^/]*)?"

# Printable characters a path may not hold, and their quoted form; the percent sign
# comes first (fixed values).
PATH_QUOTES = (
    ("%", "%25"), (" ", "%20"), ('"', "%22"), ("#", "%23"), ("<", "%3C"), (">", "%3E"),
    ("?", "%3F"), ("[", "%5B"), ("\\", "%5C"), ("]", "%5D"), ("^", "%5E"), ("`", "%60"),
    ("{", "%7B"), ("|", "%7C"), ("}", "%7D"),
)


def _or_null(text: Column) -> Column:
    return F.nullif(text, F.lit(""))


def uri_scheme(url: Column) -> Column:
    return _or_null(F.regexp_extract(url, SCHEME, 1))


def uri_authority(url: Column) -> Column:
    return _or_null(F.regexp_extract(url, AUTHORITY, 1))


def uri_path(url: Column) -> Column:
    """What follows scheme and authority; a query or fragment stays in it."""
    return F.regexp_replace(url, BEFORE_PATH, "")


def quote_path(path: Column) -> Column:
    """The path with the characters of ``PATH_QUOTES`` quoted."""
    for character, quoted in PATH_QUOTES:
        path = F.replace(path, F.lit(character), F.lit(quoted))
    return path


def container_path(path: Column, decode: bool = True) -> Column:
    """The file that holds an entry such as ``file:/a/b.jar!/c``: ``/a/b.jar``.

    A text that cannot be decoded gives null instead of failing the job.
    """
    bare = F.regexp_replace(path, "^file:", "")
    text = F.try_url_decode(bare) if decode else bare
    return F.regexp_replace(text, "!.*$", "")
