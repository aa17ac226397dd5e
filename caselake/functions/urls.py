"""Addresses: parts, parameters, resolution and the look of a PDF's."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

from .text import first_filled, strip, text


def scheme(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(text(c), r"^([A-Za-z][A-Za-z0-9+.\-]*):", 1))


def host(c: Column | str) -> Column:
    return F.lower(F.regexp_extract(text(c), r"^[A-Za-z][A-Za-z0-9+.\-]*://([^/?#]*)", 1))


def path(c: Column | str) -> Column:
    return F.regexp_extract(text(c), r"^(?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?([^?#]*)", 1)


def query(c: Column | str) -> Column:
    return F.regexp_extract(text(c), r"^[^?#]*\?([^#]*)", 1)


def is_http(c: Column | str) -> Column:
    return scheme(c).isin("http", "https") & (host(c) != "")


def decoded(c: Column) -> Column:
    """Percent signs resolved; as it stands where they are none."""
    return F.coalesce(F.try_url_decode(F.replace(c, F.lit("+"), F.lit("%2B"))), c)


def is_pdf(c: Column | str) -> Column:
    """True if path and query, decoded, name a PDF."""
    return bound(text(c), lambda t: F.contains(F.lower(bound(F.concat_ws("?", path(t), query(t)), decoded)), F.lit(".pdf")))


def looks_like_pdf(c: Column | str) -> Column:
    """As ``is_pdf``, or an address that asks for that format."""
    asked = lambda low: F.contains(low, F.lit("filetype=pdf")) | F.contains(low, F.lit("format=pdf"))
    return bound(text(c), lambda t: is_pdf(t) | asked(F.lower(t)))


def parameter(c: Column | str, name: str) -> Column:
    """The first value of a query parameter, decoded; null if it is missing or empty."""
    return F.nullif(decoded(F.regexp_extract(text(c), rf"[?&]{name}=([^&#]*)", 1)), F.lit(""))


def with_parameter(c: Column | str, name: str, value: Column) -> Column:
    """The address with that parameter set, in its place or at the end of the query."""
    there = text(c).rlike(rf"[?&]{name}=")
    put = F.regexp_replace(text(c), F.lit(rf"([?&]{name}=)[^&#]*"), F.concat(F.lit("$1"), value.cast("string")))
    cut = F.split(text(c), "#", 2)
    add = F.concat(F.get(cut, F.lit(0)), F.when(F.contains(text(c), F.lit("?")), "&").otherwise("?"), F.lit(f"{name}="), value.cast("string"), F.coalesce(F.concat(F.lit("#"), F.get(cut, F.lit(1))), F.lit("")))
    return F.when(there, put).otherwise(add)


def base_name(c: Column | str, default: str = "") -> Column:
    """The last part of the path; ``default`` if that is empty."""
    return F.coalesce(first_filled(F.substring_index(path(c), "/", -1)), F.lit(default))


def bound(value: Column, body: Callable[[Column], Column]) -> Column:
    """``body`` of a value that is worked out once, however often it is named there.

    Plain columns are put in wherever they are named, so that an expression of
    several steps would be planned and evaluated many times over.
    """
    return F.get(F.transform(F.array(value), body), F.lit(0))


def _without_dots(parts: Column) -> Column:
    """A path's parts without . and .., which takes the part before it along."""
    step = lambda kept, x: F.when(x == "..", F.slice(kept, F.lit(1), F.greatest(F.size(kept) - 1, F.lit(0)))).when(x == ".", kept).otherwise(F.concat(kept, F.array(x)))
    whole = F.aggregate(parts, F.array().cast("array<string>"), step)
    return F.concat(whole, F.when(F.element_at(parts, -1).isin(".", ".."), F.array(F.lit(""))).otherwise(F.array().cast("array<string>")))


def _from_folder(from_path: Column, to_path: Column) -> Column:
    """The parts of a path as seen from the folder of another one, without empty ones inside."""
    folder = bound(F.split(from_path, "/"), lambda p: F.when(F.element_at(p, -1) != "", F.slice(p, F.lit(1), F.size(p) - 1)).otherwise(p))
    both = F.concat(folder, F.split(to_path, "/"))
    return bound(both, lambda p: F.when(F.size(p) > 2, F.concat(F.slice(p, 1, 1), F.filter(F.slice(p, F.lit(2), F.size(p) - 2), lambda x: x != ""), F.slice(p, -1, 1))).otherwise(p))


def _with_path(a: Column) -> Column:
    """The address of a relative reference: root and from of its base, path and rest of its own."""
    parts = F.when(F.startswith(a["path"], F.lit("/")), F.split(a["path"], "/")).otherwise(_from_folder(a["from"], a["path"]))
    slash = lambda joined: F.when((joined == "") | (F.contains(a["root"], F.lit("//")) & ~F.startswith(joined, F.lit("/"))), "/").otherwise("")
    return bound(F.array_join(bound(parts, _without_dots), "/"), lambda joined: F.concat(a["root"], slash(joined), joined, a["rest"]))


def _relative(b: Column, h: Column) -> Column:
    """A reference without scheme and host, seen from a base."""
    split = F.named_struct(
        F.lit("root"), F.regexp_extract(b, r"^((?:[A-Za-z][A-Za-z0-9+.\-]*:)?(?://[^/?#]*)?)", 1), F.lit("from"), path(b), F.lit("query"), F.regexp_extract(b, r"^[^?#]*(\?[^#]*)?", 1),
        F.lit("path"), F.regexp_extract(h, r"^([^?#]*)", 1), F.lit("rest"), F.regexp_replace(F.regexp_extract(h, r"(?s)^[^?#]*(.*)$", 1), r"^\?(?=#|$)|#$", ""),
    )
    same_path = lambda a: F.concat(a["root"], a["from"], F.when(F.startswith(a["rest"], F.lit("?")), a["rest"]).otherwise(F.concat(a["query"], a["rest"])))
    return bound(split, lambda a: F.when(a["path"] == "", same_path(a)).otherwise(_with_path(a)))


def resolved(base: Column | str, href: Column | str) -> Column:
    """``href`` as seen from ``base``, all in expressions.

    An address with a scheme stands as it is; an empty one is the base.
    """

    def seen(x: Column) -> Column:
        b, h = x["b"], x["h"]
        return (
            F.when(h == "", b).when((b == "") | h.rlike(r"^[A-Za-z][A-Za-z0-9+.\-]*:"), h)
            .when(F.startswith(h, F.lit("//")), F.concat(F.regexp_extract(b, r"^([A-Za-z][A-Za-z0-9+.\-]*:)?", 1), h)).otherwise(_relative(b, h))
        )

    return bound(F.named_struct(F.lit("b"), text(base), F.lit("h"), text(href)), seen)


def built(base: str, **parameters: Column) -> Column:
    """``base`` with a query of the given parameters, in their order, encoded."""
    pairs = [F.concat(F.lit(f"{k}="), F.url_encode(text(v.cast("string")))) for k, v in parameters.items()]
    return F.concat(F.lit(base + ("&" if "?" in base else "?")), F.concat_ws("&", *pairs))


def normalized(c: Column | str, base: Column | str) -> Column:
    """Trimmed, given a scheme, resolved from ``base`` (an address, or a column of them); empty unless that is a web address."""
    from_ = F.lit(base) if isinstance(base, str) else base
    whole = lambda bare: F.when(F.startswith(bare, F.lit("//")), F.concat(F.lit("https:"), bare)).otherwise(resolved(from_, bare))
    web = lambda bare: bound(whole(bare), lambda w: F.when(is_http(w), w).otherwise(""))
    return bound(strip(text(c)), lambda bare: F.when(bare != "", web(bare)).otherwise(""))


def unescaped(c: Column | str) -> Column:
    """The five references that markup needs, resolved."""
    plain = text(c)
    for name, sign in (("&quot;", '"'), ("&#39;", "'"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&")):
        plain = F.replace(plain, F.lit(name), F.lit(sign))
    return plain


def pdf_in_text(c: Column | str) -> Column:
    """The first address of a PDF in running text or markup; null if there is none."""
    plain = unescaped(c)
    return F.nullif(F.regexp_extract(plain, r"""(?i)(https?://[^\s"'<>]+?\.pdf[^\s"'<>]*)""", 1), F.lit(""))


def pdf_file_name(title: Column, url: Column | str, default: str = "document.pdf") -> Column:
    """title__name.pdf where the address ends in such a name, else title.pdf."""
    name = base_name(url)
    return F.when(F.endswith(F.lower(name), F.lit(".pdf")) & (F.length(name) > 4), F.concat_ws("__", title, name)).otherwise(F.coalesce(F.concat(first_filled(title), F.lit(".pdf")), F.lit(default)))
