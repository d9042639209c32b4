"""Column builders for text: whitespace, keyword rules, quantities, reach, markup."""

from __future__ import annotations

from collections.abc import Callable
from html.entities import name2codepoint

from pyspark.sql import Column, functions as F

from recallspark.functions import rules as R

# Unicode white space, spelled out because Java's \s is ASCII unless a flag is given.
_SPACE = (r"[\t-\r\x1c- \x{85}\x{a0}\x{1680}\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]")


_ASCII_SPACE = r"[\t-\r\x1c- ]"

# The same characters one by one, for trimming without a regular expression.
_SPACE_CHARS = "".join(chr(i) for lo, hi in (
    (0x09, 0x0d), (0x1c, 0x20), (0x85, 0x85), (0xa0, 0xa0), (0x1680, 0x1680), (0x2000, 0x200a), (0x2028, 0x2029),
    (0x202f, 0x202f), (0x205f, 0x205f), (0x3000, 0x3000)) for i in range(lo, hi + 1))


def once(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with the value computed once a row, however often ``use`` names it."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def settled(value: Column) -> Column:
    """The value, for a projection whose filters stay above it: pushed below, each mention of the value in them
    would compute it again. The row number, always true here, is what keeps them."""
    return F.when(F.monotonically_increasing_id() >= 0, value)


def squeeze(c: Column) -> Column:
    """Collapse white-space runs to one space and trim; null becomes the empty string.

    Printable ASCII text without two spaces in a row, that is, most, is only looked through.
    """
    text = F.coalesce(c, F.lit(""))
    plain = ~F.contains(text, F.lit("  ")) & ~text.rlike("[^ -~]")
    return F.trim(F.when(plain, text).otherwise(F.regexp_replace(text, _SPACE + "+", " ")))


def strip(c: Column) -> Column:
    """Remove white space at both ends, keep it inside; null stays null."""
    return F.btrim(c, F.lit(_SPACE_CHARS))


def strip_column(name: str) -> Column:
    """``strip`` of a column: text that begins and ends with printable ASCII, that is, most, is only looked at."""
    c = F.col(name)
    last = F.substring(c, -1, 1)
    plain = (c >= "!") & (c < "\x7f") & (last >= "!") & (last < "\x7f")
    return F.when(plain, c).otherwise(strip(c))


def blank_to_null(c: Column) -> Column:
    return F.nullif(c, F.lit(""))


def join_filled(*parts: Column) -> Column:
    """Non-empty parts joined by one space (a keyword may match across the joint)."""
    return F.concat_ws(" ", *[blank_to_null(p) for p in parts])


def contains_any(haystack: Column, keywords: list[str]) -> Column:
    """True when any keyword of the list is a substring.

    A literal array under ``exists`` keeps the generated code small: one expression per rule
    instead of one branch per keyword, which would pass the size the JIT compiles.
    """
    needles = F.array(*[F.lit(w) for w in keywords])
    return F.exists(needles, lambda w: F.contains(haystack, w))


def first_match(haystack: Column, rules: list[tuple[str, list[str]]]) -> Column:
    """Label of the first rule with a keyword inside the (already lower-cased) text."""
    def label_of(text: Column) -> Column:
        chain = F
        for label, keywords in rules:
            chain = chain.when(contains_any(text, keywords), label)
        return chain.otherwise(R.OTHER)

    return once(haystack, label_of)


def title_case(c: Column) -> Column:
    """Upper-case every letter that follows a non-letter (``INTRA-ARTICULAR`` -> ``Intra-Articular``).

    ``initcap`` only restarts after a space, so a marked space is put behind each non-letter
    first and taken out again afterwards.
    """
    mark = "\u0001 "
    return F.replace(F.initcap(F.regexp_replace(c, r"([^\p{L}])", "$1" + mark)), F.lit(mark), F.lit(""))


def parse_quantity(c: Column) -> Column:
    """First run of digits and commas as a number; a run of commas only gives null."""
    run = F.regexp_extract(c, r"[\d,]+", 0)
    return F.replace(run, F.lit(","), F.lit("")).try_cast("decimal(38,0)")


def state_reach(c: Column) -> Column:
    """Estimated number of states in a distribution text: 50 for nation-wide wording, else
    distinct two-capital tokens plus state names found (0 for null or nothing)."""
    text = F.coalesce(c, F.lit(""))
    tokens = F.size(F.array_distinct(F.regexp_extract_all(text, F.lit(r"\b([A-Z]{2})\b"), F.lit(1))))
    names = F.array(*[F.lit(n) for n in R.STATE_NAMES])
    named = once(F.lower(text), lambda t: F.when(contains_any(t, R.REACH_EVERYWHERE_WORDS), F.lit(-1)).otherwise(
        F.size(F.filter(names, lambda n: F.contains(t, n)))))
    return once(named, lambda n: F.when(n < 0, R.REACH_EVERYWHERE).otherwise(tokens + n))


def markup_text(c: Column) -> Column:
    """Visible text of an HTML fragment: comments and tags (with the white space around them)
    removed, the common entities decoded."""
    def bare(text: Column) -> Column:
        whole = F.when(F.contains(text, F.lit("<!--")), F.regexp_replace(text, r"(?s)<!--.*?-->", "")).otherwise(text)
        # ASCII text, as long in bytes as in characters, needs the ASCII part of the white space only
        tags = [F.regexp_replace(whole, f"{space}*+<[^>]*+>{space}*+", "") for space in (_ASCII_SPACE, _SPACE)]
        return F.when(~F.contains(text, F.lit("<")), text).otherwise(
            F.when(F.octet_length(text) == F.length(text), tags[0]).otherwise(tags[1]))

    return once(once(c, bare), lambda text: strip(decode_entities(text)))


def decode_entities(c: Column) -> Column:
    """Named (HTML 4) and numeric character references; unknown ones stay as they are."""
    names = F.create_map(*[F.lit(x) for name, code in sorted(name2codepoint.items()) for x in (name, chr(code))])

    def char(code: Column) -> Column:
        return F.decode(F.unhex(F.lpad(code, 8, "0")), "UTF-32")

    def value(ref: Column) -> Column:
        number = F.lower(F.substring(ref, 2, 10))
        return (F.when(number.rlike("^x[0-9a-f]{1,6}$") & ref.startswith("#"), char(F.substring(number, 2, 8)))
                .when(number.rlike("^[0-9]{1,7}$") & ref.startswith("#"), char(F.hex(number.cast("int"))))
                .otherwise(F.coalesce(F.try_element_at(names, ref), F.concat(F.lit("&"), ref, F.lit(";")))))

    found = F.array_distinct(F.regexp_extract_all(c, F.lit("&(#[xX]?[0-9a-fA-F]+|[A-Za-z][A-Za-z0-9]*);"), F.lit(1)))
    # the ampersand last, or "&amp;lt;" would be decoded twice
    ordered = F.concat(F.filter(found, lambda r: value(r) != "&"), F.filter(found, lambda r: value(r) == "&"))
    decoded = F.aggregate(ordered, c, lambda text, r: F.replace(text, F.concat(F.lit("&"), r, F.lit(";")), value(r)))
    return F.replace(F.when(F.contains(c, F.lit("&")), decoded).otherwise(c), F.lit("\u00a0"), F.lit(" "))
