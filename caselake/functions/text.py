"""Text and file-name functions as Column expressions.

White space is Unicode's throughout; Java's own class leaves out the no-break
and other wide spaces, so the class is spelled out.  Missing text counts as empty.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column
from pyspark.sql import functions as F

# White space, and the characters that names must not hold.
WS = r"\s\u00A0\u1680\u2000-\u200A\u2028\u2029\u202F\u205F\u3000\u001C-\u001F\u0085"
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
FORBIDDEN = r'<>:"/\\|?*'
MONTHS = ("january", "february", "march", "april", "may", "june", "july", "august", "september", "october", "november", "december")


def text(c: Column | str) -> Column:
    return F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))


def strip(c: Column, signs: str = SPACES) -> Column:
    """``c`` without any of the characters ``signs`` at either end."""
    return F.btrim(c, F.lit(signs))


def clean_ws(c: Column | str) -> Column:
    """Runs of white space become one space; none is left at the ends.

    A single space is no match, so that most of a text is passed over.
    """
    return strip(F.regexp_replace(text(c), f"[{WS}&&[^ ]][{WS}]*| [{WS}]+", " "), " ")


def or_unknown(c: Column) -> Column:
    return F.coalesce(F.nullif(c, F.lit("")), F.lit("unknown"))


def _begin(c: Column, name: Callable[[Column], Column], most: int) -> Column:
    """The first ``most`` characters of ``name(c)``.

    A name of a text's beginning is the beginning of the whole text's name, but
    for its last character.  So a longer beginning, and at last the whole text,
    is read only where a shorter one does not give enough characters; each is
    read once.
    """

    def of(times: int, longer: Column) -> Column:
        whole = F.char_length(c) <= times * most
        near = F.array(name(F.substring(c, 1, times * most)))
        return F.get(F.transform(near, lambda t: F.when(whole | (F.char_length(t) > most + 1), t).otherwise(longer)), F.lit(0))

    return F.substring(of(2, of(8, name(c))), 1, most)


def slugify(c: Column | str, most: int = 60) -> Column:
    """Lower-case words of letters, digits and hyphens, joined by hyphens; ``unknown`` if nothing is left."""
    kept = lambda t: strip(F.regexp_replace(F.lower(t), rf"[^\p{{L}}\p{{N}}_{WS}-]", ""))
    joined = lambda t: F.regexp_replace(F.regexp_replace(kept(t), f"[{WS}_]+", "-"), "-+", "-")
    return or_unknown(strip(_begin(text(c), joined, most), "-"))


def folder_name(c: Column | str, most: int = 120) -> Column:
    """Forbidden characters go, white space becomes a hyphen; hyphens and dots go at the ends before the cut."""
    return _begin(text(c), lambda t: strip(F.regexp_replace(F.regexp_replace(t, f"[{FORBIDDEN}]", ""), f"[{WS}]+", "-"), "-."), most)


def masked_name(c: Column | str, most: int = 200) -> Column:
    """Every forbidden character becomes an underscore."""
    return F.regexp_replace(F.substring(text(c), 1, most), f"[{FORBIDDEN}]", "_")


def word_name(c: Column | str, most: int = 200) -> Column:
    """Letters, digits, underscores and hyphens; white space becomes one underscore."""
    return _begin(text(c), lambda t: strip(F.regexp_replace(F.regexp_replace(t, rf"[^\p{{L}}\p{{N}}_{WS}-]", ""), f"[{WS}]+", "_"), "_"), most)


def run_masked_name(c: Column | str, most: int = 180) -> Column:
    """Each run of forbidden characters becomes one underscore, white space one space; cut, then no space at the end."""
    kept = lambda t: strip(F.regexp_replace(F.regexp_replace(t, f"[{FORBIDDEN}]+", "_"), f"[{WS}]+", " "))
    return F.rtrim(_begin(text(c), kept, most), F.lit(SPACES))


def listed_name(c: Column | str, allowed: str = r"A-Za-z0-9._ \-", ends: str = "._ ", most: int = 180, default: str = "file") -> Column:
    """Each run of characters outside the class ``allowed`` becomes an underscore; ``ends`` go at both ends."""
    kept = lambda t: strip(F.regexp_replace(clean_ws(t), f"[^{allowed}]+", "_"), ends)
    return F.coalesce(F.nullif(_begin(text(c), kept, most), F.lit("")), F.lit(default))


def header_name(c: Column | str) -> Column:
    """A column name from a table's heading."""
    lower = F.replace(F.lower(text(c)), F.lit("#"), F.lit("no"))
    return strip(F.regexp_replace(strip(lower), f"[{WS}]+", "_"), "_")


def before_dash(c: Column | str) -> Column:
    """What stands before the first em dash; without one, en dash; without that, hyphen.  Only if anything does."""
    out = text(c)
    for dash in ("-", "–", "—"):
        at = F.instr(text(c), dash)
        left = strip(F.substring(text(c), F.lit(1), at - 1))
        out = F.when((at > 0) & (left != ""), left).otherwise(out)
    return strip(out)


def case_numbers(c: Column | str, pattern: str = r"\b(S\d{2}[A-Z]\d{4})\b") -> Column:
    """All case numbers in ``c``, repeats included, in order."""
    return F.regexp_extract_all(text(c), F.lit(pattern), F.lit(1))


def case_title(c: Column | str, pattern: str = r"\bS\d{2}[A-Z]\d{4}\b") -> Column:
    """What follows the first full stop and space; without one, the text without its case numbers."""
    parts = F.split(text(c), r"\. ", 2)
    bare = strip(F.regexp_replace(text(c), pattern, ""), SPACES + ",.")
    return F.when(F.size(parts) > 1, strip(F.get(parts, F.lit(1)))).otherwise(bare)


def month_in(c: Column | str) -> Column:
    """The first month of the year whose name's first three letters occur anywhere; else null."""
    low = F.lower(text(c))
    return F.coalesce(*[F.when(F.contains(low, F.lit(m[:3])), F.lit(m.capitalize())) for m in MONTHS])


def without_final_capitals(c: Column | str) -> Column:
    return F.regexp_replace(text(c), "[A-Z]+$", "")


def first_filled(*cols: Column | str) -> Column:
    """The first column that is neither null nor empty; else null."""
    return F.coalesce(*[F.nullif(F.col(c) if isinstance(c, str) else c, F.lit("")) for c in cols])


def best_text(*cols: Column | str) -> Column:
    """The first column that holds more than white space, as it stands; else empty."""
    return F.coalesce(*[F.when(strip(text(c)) != "", text(c)) for c in cols], F.lit(""))


def joined(sep: str, *cols: Column | str, default: str = "") -> Column:
    """The filled columns joined by ``sep``; ``default`` if there are none."""
    return F.coalesce(F.nullif(F.concat_ws(sep, *[F.nullif(text(c), F.lit("")) for c in cols]), F.lit("")), F.lit(default))


def record_folder(number: Column | str, raw: Column | str, key: Column | str, name: Column | str, short: Column | str) -> Column:
    """number_name as slugs; the number falls back on raw and key, the name on its short form and may be left out."""
    dn, cn = slugify(first_filled(number, raw, F.col(key).cast("string") if isinstance(key, str) else key.cast("string"))), slugify(first_filled(name, short))
    return F.when(cn == "unknown", dn).otherwise(F.concat_ws("_", dn, cn))


def split_once(c: Column | str, sep: str) -> Column:
    """An array of one or two parts, cut at the first ``sep`` (a literal)."""
    at = F.instr(text(c), sep)
    return F.when(at > 0, F.array(F.substring(text(c), F.lit(1), at - 1), F.substring(text(c), at + len(sep), F.length(text(c))))).otherwise(F.array(text(c)))


def looks_blocked(c: Column | str) -> Column:
    """True for a page that says the request was turned away."""
    low = F.lower(text(c))
    return F.contains(low, F.lit("request rejected")) | (F.contains(low, F.lit("support id")) & F.contains(low, F.lit("rejected")))


def is_html_instead(content: Column | str, most: int = 1200) -> Column:
    """True for a small body that begins as a web page; ``content`` is binary."""
    body = F.col(content) if isinstance(content, str) else content
    head = F.lower(F.decode(F.substring(body, 1, 200), "ISO-8859-1"))
    return F.coalesce((F.octet_length(body) < most) & (F.contains(head, F.lit("<html")) | F.contains(head, F.lit("doctype html"))), F.lit(False))


def is_too_small(content: Column | str, least: int = 1000) -> Column:
    body = F.col(content) if isinstance(content, str) else content
    return F.coalesce(F.octet_length(body), F.lit(0)) < least
