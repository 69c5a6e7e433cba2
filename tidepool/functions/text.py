"""Markup to text, entities and tokens as Column expressions."""

from __future__ import annotations

from html.entities import name2codepoint

from pyspark.sql import Column
from pyspark.sql import functions as F

# Elements whose tags separate words (block, list, table, form and break elements).
_BLOCK_TAGS = (
    "address|article|aside|blockquote|body|br|caption|center|dd|details|dialog|dir|div|dl|dt|"
    "fieldset|figcaption|figure|footer|form|frameset|h[1-6]|head|header|hgroup|hr|html|legend|li|"
    "link|main|menu|meta|nav|noscript|ol|optgroup|option|p|pre|section|select|summary|table|tbody|"
    "td|textarea|tfoot|th|thead|title|tr|ul"
)

# What is no text at all, and then tags; pattern and replacement, applied in this order.  All
# patterns mean the same in RE2.
HIDDEN_STEPS = [
    (r"(?s)<!--.*?-->", " "),
    (r"(?is)<script\b[^>]*>.*?</script\s*>", " "),
    (r"(?is)<style\b[^>]*>.*?</style\s*>", " "),
]
TAG_STEPS = [(rf"(?i)</?(?:{_BLOCK_TAGS})\b[^>]*>", " "), (r"<[^>]*>", "")]
BLANKS = r"[\p{Z}\s]+"

WORD = r"[\p{L}\p{M}\p{N}_]+"
WORD_OR_MARK = r"[\p{L}\p{M}\p{N}_]+|[^\p{Z}\s]"

# The five markup characters, encoded before and decoded apart from the others.
MARKUP_ENTITIES = {"amp": "&", "quot": '"', "lt": "<", "gt": ">", "nbsp": "\u00a0"}

# Further names that occur in most pages.
COMMON_ENTITIES = ("middot", "bull", "copy", "reg", "trade", "ndash", "mdash", "hellip", "lsquo", "rsquo",
                   "ldquo", "rdquo", "laquo", "raquo")


def named_entities() -> dict[str, str]:
    """The other named entities of HTML 4, from the Latin ones to the symbols, by character."""
    names = sorted(name2codepoint.items(), key=lambda x: x[1])
    return {name: chr(code) for name, code in names if name not in MARKUP_ENTITIES}


def without_hidden(html: Column) -> Column:
    """Markup without comments, scripts and style sheets; one search tells markup that has none."""
    shown = html
    for pattern, put in HIDDEN_STEPS:
        shown = F.regexp_replace(shown, pattern, put)
    return F.when(html.rlike("(?i)<!--|<script|<style"), shown).otherwise(html)


def html_to_text(html: Column | str) -> Column:
    """Visible text with entities decoded and white space collapsed; a chain of regular expressions,
    not a DOM."""
    text = without_hidden(F.col(html) if isinstance(html, str) else html)
    for pattern, put in TAG_STEPS:
        text = F.regexp_replace(text, pattern, put)
    return F.trim(F.regexp_replace(decode_entities(text), BLANKS, " "))


def tokens(text: Column | str, words_only: bool = True) -> Column:
    """Array of the words (and, if asked, single punctuation marks) of a text, in order."""
    return F.regexp_extract_all(text, F.lit(WORD if words_only else WORD_OR_MARK), F.lit(0))


def _literal_map(entries: dict[str, str]) -> Column:
    return F.create_map(*[F.lit(x) for pair in entries.items() for x in pair])


def encode_entities(text: Column | str) -> Column:
    """Characters to named entities: markup characters first, then all others with a name."""
    out = F.col(text) if isinstance(text, str) else text
    for name, char in MARKUP_ENTITIES.items():
        out = F.replace(out, F.lit(char), F.lit(f"&{name};"))
    by_code = {ord(char): name for name, char in named_entities().items()}
    # One constant array with a place for every character, so a look-up is one step.
    names = F.split(F.lit("|".join(by_code.get(c, "") for c in range(max(by_code) + 1))), r"\|")

    def spell(char: Column) -> Column:
        name = F.get(names, F.ascii(char))
        return F.when(F.coalesce(name, F.lit("")) == "", char).otherwise(
            F.concat(F.lit("&"), name, F.lit(";")))

    spelled = F.array_join(F.transform(F.split(out, ""), spell), "")
    return F.when(out.rlike("[^\\x00-\\x7F]"), spelled).otherwise(out)


def _character(code: Column) -> Column:
    """The character of a code point, null if there is none."""
    valid = (code > 0) & (code < 0x110000) & ~code.between(0xD800, 0xDFFF)
    return F.when(valid, F.decode(F.unhex(F.lpad(F.hex(code), 8, "0")), "UTF-32"))


def decode_entities(text: Column | str) -> Column:
    """Named and numeric entities to characters in one pass; an unknown one stays as it is.

    The names that make up nearly all there is in most texts are replaced one by one, the ampersand
    last, so that what it brings about is not decoded again.  Only a text in which some other
    reference is left is taken to pieces.
    """
    src = F.col(text) if isinstance(text, str) else text
    names = named_entities()
    common = MARKUP_ENTITIES | {name: names[name] for name in COMMON_ENTITIES}
    for name, char in common.items():
        if name != "amp":
            src = F.replace(src, F.lit(f"&{name};"), F.lit(char))
    return F.when(src.rlike("&(?!amp;)"), _decode_pieces(src)).otherwise(
        F.replace(src, F.lit("&amp;"), F.lit("&")))


def _decode_pieces(src: Column) -> Column:
    chars = _literal_map({"amp": "&", **named_entities()})
    pieces = F.split(src, "&")

    def restore(piece: Column) -> Column:
        name = F.regexp_extract(piece, "^(#?[A-Za-z0-9]+);", 1)
        digits = F.regexp_extract(name, "^#(?:([0-9]{1,7})|[xX]([0-9A-Fa-f]{1,6}))$", 0)
        code = F.when(digits.rlike("^#[0-9]"), F.substr(digits, F.lit(2)).try_cast("long")).otherwise(
            F.conv(F.substr(digits, F.lit(3)), 16, 10).cast("long"))
        char = F.when(digits != "", _character(code)).when(
            name != "", F.try_element_at(chars, name))
        return F.when(char.isNotNull(), F.concat(char, F.substr(piece, F.length(name) + 2))
                      ).otherwise(F.concat(F.lit("&"), piece))

    tail = F.transform(F.slice(pieces, F.lit(2), F.size(pieces) - 1), restore)
    return F.concat(F.element_at(pieces, 1), F.array_join(tail, ""))


def percent_escape(value: Column | str, chars: str) -> Column:
    """Percent-encode the listed ASCII characters (and the percent sign itself)."""
    out = F.replace(F.col(value) if isinstance(value, str) else value, F.lit("%"), F.lit("%25"))
    for c in chars:
        out = F.replace(out, F.lit(c), F.lit(f"%{ord(c):02X}"))
    return out


def percent_restore(value: Column | str, chars: str) -> Column:
    out = F.col(value) if isinstance(value, str) else value
    for c in chars:
        out = F.replace(out, F.lit(f"%{ord(c):02X}"), F.lit(c))
    return F.replace(out, F.lit("%25"), F.lit("%"))
