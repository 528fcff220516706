"""URL normal form (P9, opt-in): one spelling for URLs that mean the same.

White space around the URL and line breaks in it go; scheme and host are in
lower case, international host names in their ASCII form (Bootstring, label by
label, composed and in lower case before); default and empty ports go; ``.`` and
``..`` segments of the path are resolved and an empty path is ``/``; escapes are
in upper case, those of letters, digits and ``-._~`` are decoded, and characters
that a URL cannot hold (also a ``%`` without two hex digits) are escaped as
UTF-8; the fragment goes.  Parameters keep their order.  Text that is no URL with
scheme and host stays as it is.

All but the host names are JVM expressions; only hosts with other than ASCII
characters reach a Python worker, as Arrow batches of hosts.
"""

from __future__ import annotations

import unicodedata

import pyarrow as pa
from pyspark.sql import Column
from pyspark.sql import functions as F

# scheme, authority, path, query (RFC 3986, appendix B) of a URL with an authority
_PARTS = r"^([A-Za-z][A-Za-z0-9+.-]*)://([^/?#]*)([^?#]*)(\?[^#]*)?"
_DEFAULT_PORTS = {"http": "80", "https": "443", "ftp": "21", "ws": "80", "wss": "443"}
_UNRESERVED = r"[A-Za-z0-9._~-]"
#: Characters that a path or query cannot hold as they are.
_FOREIGN = r"[^\x21\x23-\x3B\x3D\x3F-\x5B\x5D\x5F\x61-\x7A\x7E]"


def ascii_label(label: str) -> str:
    label = unicodedata.normalize("NFKC", label).lower()
    return label if label.isascii() else "xn--" + label.encode("punycode").decode("ascii")


def ascii_host(host: str) -> str:
    """A host name in ASCII; ideographic full stops part labels too."""
    for stop in "。．｡":
        host = host.replace(stop, ".")
    return ".".join(ascii_label(x) for x in host.split("."))


def _convert(hosts: pa.Array) -> pa.Array:
    return pa.array([None if h is None else ascii_host(h) for h in hosts.to_pylist()], pa.string())


_convert.__annotations__ = {"hosts": pa.Array, "return": pa.Array}


def _escapes(text: Column) -> Column:
    """Foreign characters escaped; escapes in upper case, or decoded where they need not be."""
    foreign = F.array_join(F.transform(F.split(text, ""), lambda c: F.when(
        c.rlike(_FOREIGN), F.regexp_replace(F.hex(F.encode(c, "UTF-8")), "(..)", "%$1")).otherwise(c)), "")
    whole = F.when(text.rlike(_FOREIGN), foreign).otherwise(text)
    parts = F.split(whole, "%")

    def one(part: Column) -> Column:
        code = F.upper(F.substring(part, 1, 2))
        char = F.char(F.conv(code, 16, 10).cast("int"))
        rest = F.substring(part, 3, 1 << 30)
        return (F.when(~part.rlike("^[0-9A-Fa-f]{2}"), F.concat(F.lit("%25"), part))
                .when(code.rlike("^[2-7]") & char.rlike(f"^{_UNRESERVED}$"), F.concat(char, rest))
                .otherwise(F.concat(F.lit("%"), code, rest)))

    joined = F.concat(parts[0], F.array_join(F.transform(F.slice(parts, 2, F.size(parts)), one), ""))
    return F.when(whole.contains("%"), joined).otherwise(whole)


def _without_dots(path: Column) -> Column:
    """A path (empty or from its first slash) without ``.`` and ``..`` segments."""
    segments = F.split(path, "/")
    kept = F.aggregate(
        F.slice(segments, 2, F.size(segments)), F.array().cast("array<string>"),
        lambda done, s: F.when(s == ".", done)
        .when(s == "..", F.slice(done, F.lit(1), F.greatest(F.size(done) - 1, F.lit(0))))
        .otherwise(F.concat(done, F.array(s))))
    # a path that ends in one names a folder
    ended = F.when(F.element_at(segments, -1).isin(".", ".."), F.concat(kept, F.array(F.lit("")))).otherwise(kept)
    return F.when(path.rlike(r"/\.\.?(/|$)"), F.concat(F.lit("/"), F.array_join(ended, "/"))).otherwise(path)


def normal_form(url) -> Column:
    """The URL in normal form; NULL stays NULL."""
    u = F.col(url) if isinstance(url, str) else url
    u = F.regexp_replace(F.regexp_replace(u, r"^[\x00-\x20]+|[\x00-\x20]+$", ""), r"[\t\r\n]", "")
    scheme = F.lower(F.regexp_extract(u, _PARTS, 1))
    authority = F.regexp_extract(u, _PARTS, 2)
    user = F.regexp_extract(authority, r"^(.*@)", 1)
    named = F.substring(authority, F.length(user) + 1, F.lit(1 << 30))
    host = F.regexp_extract(named, r"^(\[[^\]]*\]|[^:]*)", 1)
    port = F.regexp_extract(named, r":([0-9]*)$", 1)
    foreign = host.rlike(r"[^\x00-\x7F]")
    ascii_ = F.coalesce(F.arrow_udf(_convert, "string")(F.when(foreign, host)), F.lower(host))
    default = F.coalesce(*[F.when(scheme == s, F.lit(p)) for s, p in _DEFAULT_PORTS.items()], F.lit(""))
    port = F.when((port == "") | (port == default), "").otherwise(F.concat(F.lit(":"), port))
    path = _without_dots(_escapes(F.regexp_extract(u, _PARTS, 3)))
    path = F.when(path == "", "/").otherwise(path)
    query = _escapes(F.coalesce(F.regexp_extract(u, _PARTS, 4), F.lit("")))
    whole = F.concat(scheme, F.lit("://"), user, ascii_, port, path, query)
    return F.when(u.rlike(_PARTS) & (host != ""), whole).otherwise(F.col(url) if isinstance(url, str) else url)
