"""Parts of a captured request text as column expressions.

A request is text: a request line (its first line that is not empty), header lines, then either a JSON payload on the
last line (GET, which may have none) or ``name[[:]]value`` lines (all other methods).
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import PAIR_SEP, after_first

# The methods of HTTP.
METHODS = ("GET", "HEAD", "POST", "PUT", "DELETE", "CONNECT", "OPTIONS", "TRACE", "PATCH")
REQUEST_LINE = rf"^\s*({'|'.join(METHODS)})[ \t]+(\S+)"
HOST_LINE = r"(?im)^[ \t]*host[ \t]*:[ \t]*(?:[^@\s]*@)?(\[[^\]\s]*\]|[^:\s]*)"
# A header name has none of these; lines such as form bodies or JSON are not headers.
NOT_IN_HEADER_NAME = " \t=&?{}[]<>\"'"
HEADER_LINE = r"^[ \t]*[A-Za-z0-9!#$%&'*+.^_`|~-]+[ \t]*:"
URL_HOST = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#\s]*@)?(\[[^\]/?#]*\]|[^/:?#]+)"

_WHITE = " \t\f"


def url_host(url: Column) -> Column:
    """Host of an absolute URL in lower case, without port or userinfo; empty when there is none."""
    return F.lower(F.regexp_extract(url, URL_HOST, 1))


def _trim(s: Column) -> Column:
    """Without blanks at both ends; tabs are rare, and trimming blanks alone is much faster."""
    return F.when(s.contains("\t") | s.contains("\f"), F.btrim(s, F.lit(_WHITE))).otherwise(F.trim(s))


def body(text: Column) -> Column:
    """The text with uniform line ends and without the last one, which adds no line."""
    uniform = F.replace(F.replace(text, F.lit("\r\n"), F.lit("\n")), F.lit("\r"), F.lit("\n"))
    uniform = F.when(text.contains("\r"), uniform).otherwise(text)
    return F.when(
        text.endswith("\n") | text.endswith("\r"), F.substr(uniform, F.lit(1), F.length(uniform) - 1)
    ).otherwise(uniform)


def lines(text_body: Column) -> Column:
    """Trimmed lines of a :func:`body`."""
    return F.transform(F.split(text_body, "\n"), _trim)


def is_multipart(text_body: Column) -> Column:
    return text_body.rlike(r"(?i)form-data")


def header_lines(text_body: Column, all_lines: Column, multipart: Column) -> Column:
    """The lines that may be headers: those of a multipart form above the first empty line, else all.

    The values of a multipart form stand on lines of their own and must not be taken for headers.
    """
    return F.when(multipart, lines(F.substring_index(text_body, "\n\n", 1))).otherwise(all_lines)


def multipart_has_field(text_body: Column, names: Iterable[str]) -> Column:
    """True when a multipart form has a field with one of ``names``."""
    return text_body.rlike(rf"(?i)\bname=[\"']?(?:{'|'.join(names)})[\"'\s;]")


def last_line(text_body: Column) -> Column:
    return F.substring_index(text_body, "\n", -1)


def host(text: Column) -> Column:
    """Host header in lower case, without port or userinfo; empty when absent."""
    return F.lower(F.regexp_extract(text, HOST_LINE, 1))


def url(text: Column) -> Column:
    """Second token of the request line, unredacted: pass it through ``redact_url`` before output."""
    return F.regexp_extract(text, REQUEST_LINE, 2)


def method(text: Column) -> Column:
    """The method of the request line; null when the text has no such line."""
    return F.nullif(F.regexp_extract(text, REQUEST_LINE, 1), F.lit(""))


def has_payload(text_body: Column) -> Column:
    """True when the last line is neither empty nor a header nor the request line, so must be the payload."""
    line = last_line(text_body)
    return text_body.contains("\n") & line.rlike(r"\S") & ~line.rlike(HEADER_LINE)


def payload_entries(line: Column) -> Column:
    """Entries of the ``data`` member of a line of JSON, names lowercased; null if the line is broken.

    ``data`` may be an object or a text that holds one.
    """
    payload = F.replace(line, F.lit(PAIR_SEP), F.lit(":"))
    options = {"allowUnquotedFieldNames": "true"}
    data = F.from_json(payload, "data string", options)["data"]
    return lower_keys(F.map_entries(F.from_json(data, "map<string,string>", options)))


def json_entries(text: Column) -> Column:
    """Entries of a flat JSON object, names lowercased; null if it is not one."""
    return lower_keys(F.map_entries(F.from_json(text, "map<string,string>")))


def lower_keys(entries: Column) -> Column:
    return F.transform(
        entries, lambda e: F.struct(F.lower(e["key"]).alias("key"), e["value"].alias("value"))
    )


def _is_pair(line: Column) -> Column:
    """The line has the pair separator and some text after the first one."""
    rest = F.replace(after_first(line, PAIR_SEP), F.lit(PAIR_SEP), F.lit(""))
    return line.contains(PAIR_SEP) & (rest != "")


def form_entries(request_lines: Column) -> Column:
    """``name[[:]]value`` lines as entries, names lowercased, in order; pairs without value dropped."""
    return F.transform(
        F.filter(request_lines, _is_pair),
        lambda s: F.struct(
            F.lower(F.substring_index(s, PAIR_SEP, 1)).alias("key"),
            F.substring_index(after_first(s, PAIR_SEP), PAIR_SEP, 1).alias("value"),
        ),
    )


def header_entries(request_lines: Column) -> Column:
    """``name: value`` lines as entries, names lowercased; the value is all after the first colon.

    The host has a column of its own. Without a pattern: this runs for every line of every request.
    """
    candidates = F.transform(
        F.filter(request_lines, lambda s: s.contains(":") & ~s.endswith(":") & ~_is_pair(s)),
        lambda s: F.struct(
            F.lower(_trim(F.substring_index(s, ":", 1))).alias("key"),
            _trim(after_first(s, ":")).alias("value"),
        ),
    )
    return F.filter(
        candidates,
        lambda e: (e["key"] != "") & (e["key"] != "host") & (F.translate(e["key"], NOT_IN_HEADER_NAME, "") == e["key"]),
    )


def url_has_param(raw_url: Column, names: Iterable[str]) -> Column:
    """True when the URL carries a non-empty parameter with one of ``names``."""
    return raw_url.rlike(rf"(?i)[?&;#](?:{'|'.join(names)})=[^&;#\s]")


def has_authorization(text: Column, scheme: str) -> Column:
    """True when a header line, of any method, carries credentials of this scheme (``basic``, ``bearer``)."""
    return text.rlike(rf"(?im)^[ \t]*(?:proxy-)?authorization[ \t]*:[ \t]*{scheme}[ \t]+\S")


def has_session_cookie(text: Column) -> Column:
    """True when a cookie line names a session."""
    name = r"[^=;\s]*(?:sess|token|auth|jwt|(?<![a-z0-9])sid(?![a-z0-9]))[^=;\s]*"
    return text.rlike(rf"(?im)^[ \t]*(?:set-)?cookie[ \t]*:(?:[^\r\n]*;)?[ \t]*{name}=[^;\s]")


def has_userinfo(raw_url: Column) -> Column:
    return raw_url.rlike(r"(?i)^[a-z][a-z0-9+.-]*://[^/?#\s@]+@")
