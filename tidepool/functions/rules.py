"""Row rules (validators) as boolean Columns; null values fail."""

from __future__ import annotations

import string

from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F

# Published number ranges of payment cards.
CARDS = {
    "mc": "5[1-5][0-9]{14}",
    "ec": "5[1-5][0-9]{14}",
    "vi": "4(?:[0-9]{12}|[0-9]{15})",
    "ax": "3[47][0-9]{13}",
    "dc": "3(?:0[0-5][0-9]{11}|[68][0-9]{12})",
    "bl": "3(?:0[0-5][0-9]{11}|[68][0-9]{12})",
    "di": "6011[0-9]{12}",
    "jcb": "(?:3[0-9]{15}|(2131|1800)[0-9]{11})",
    "er": "2(?:014|149)[0-9]{11}",
}
CVV_LENGTH = {"mc": 3, "ec": 3, "vi": 3, "di": 3, "ax": 4}

# Accepted spellings; # is a digit, ? a digit that may be missing.
US_PHONE = ["###-###-####", "(###) ###-####", "(###) ### ####", "###.###.####", "###/###-####",
            "### ### ####", "###-###-#### x#???", "(###) ###-#### x#???", "(###) ### #### x#???",
            "###.###.#### x#???", "###/###-#### x#???", "### ### #### x#???", "##########"]
US_SSN = ["###-##-####", "### ## ####", "#########"]
US_ZIP = ["#####-####", "##### ####", "#########", "#####"]
CA_SIN = ["###-###-###", "### ### ###", "#########"]

# Postal abbreviations.
US_STATES = ("AL AK AZ AR CA CO CT DE DC FL GA HI ID IL IN IA KS KY LA ME MD MA MI MN MS MO MT NE "
             "NV NH NJ NM NY NC ND OH OK OR PA RI SC SD TN TX UT VT VA WA WV WI WY").split()
US_TERRITORIES = "AS FM GU MH MP PW PR VI".split()
US_MILITARY = "AA AE AP".split()
CA_PROVINCES = "AB BC MB NB NL NS NT NU ON PE QC SK YT".split()

# Characters of a mail name's atoms (RFC 5322, 3.2.3) and of a host's labels (RFC 1123, 2.1).
ATOM = r"^[A-Za-z0-9!#$%&'*+/=?^_`{|}~-]+$"
LABEL_CHARACTERS = string.ascii_lowercase + string.digits + "-"
LABEL_MAX, ADDRESS_MAX = 63, 0xFFFFFFFF

# How Brazilian tax numbers of persons and of companies are written.
BR_CPF = ["###.###.###-##", "#########-##", "###########"]
BR_CNPJ = ["##.###.###/####-##", "########/####-##", "############-##", "##############"]


def _text(value: Column | str) -> Column:
    return (F.col(value) if isinstance(value, str) else value).cast("string")


def _bare(value: Column | str) -> Column:
    return F.regexp_replace(_text(value), "[- ]", "")


def _sure(cond: Column) -> Column:
    return F.coalesce(cond, F.lit(False))


def whole(value: Column | str, pattern: str) -> Column:
    """The whole value matches, upper and lower case alike."""
    return _sure(_text(value).rlike(f"(?i)^(?:{pattern})$"))


def is_text(value: Column | str, length: int | None = None, minlength: int | None = None,
            maxlength: int | None = None) -> Column:
    text = _text(value)
    ok = ~text.rlike(r"^\s*$")
    if length is not None:
        ok = ok & (F.length(text) == length)
    if minlength is not None:
        ok = ok & (F.length(text) >= minlength)
    if maxlength is not None:
        ok = ok & (F.length(text) <= maxlength)
    return _sure(ok)


def in_range(value: Column | str, low: float | None = None, high: float | None = None) -> Column:
    number = _text(value).try_cast("double")
    ok = number.isNotNull() & ~F.isnan(number)
    if low is not None:
        ok = ok & (number >= low)
    if high is not None:
        ok = ok & (number <= high)
    return _sure(ok)


def number_format_pattern(formats: Sequence[str]) -> str:
    spelled = {"#": r"\d", "?": r"\d?"}
    return "|".join("".join(spelled.get(c, c if c.isalnum() or c == " " else "\\" + c)
                            for c in f) for f in formats)


def number_format(value: Column | str, formats: Sequence[str]) -> Column:
    return whole(value, number_format_pattern(formats))


def luhn(value: Column | str) -> Column:
    """Check digit of a number; dashes and blanks are ignored."""
    return _sure(F.call_function("luhn_check", _bare(value)))


def _parts(value: Column, separator: str, n: int, good) -> Column:
    """Exactly ``n`` parts, all of them good."""
    parts = F.split(value, separator)
    return (F.size(parts) == n) & F.forall(parts, good)


def _octet(part: Column) -> Column:
    return part.rlike("^(0|[1-9][0-9]{0,2})$") & (part.try_cast("int") <= 255)


def _made_of(value: Column, characters: str) -> Column:
    return (value != "") & (F.translate(value, characters, "") == "")


def _hex_up_to(value: Column, most: int) -> Column:
    """``0x`` and hexadecimal digits that stand for at most ``most``."""
    digits = F.substr(value, F.lit(3))
    short = F.ltrim(digits, F.lit("0"))
    known = value.startswith("0x") & _made_of(digits, "0123456789abcdef") & (F.length(short) < 16)
    return known & F.when(known & (short != ""), F.conv(short, 16, 10).cast("long") <= most).otherwise(
        F.lit(True))


def _hex_octet(part: Column) -> Column:
    return _hex_up_to(part, 255)


def _octal_octet(part: Column) -> Column:
    """A leading zero and three octal digits, at most 377."""
    return part.rlike("^0+[0-7]{3}$") & (F.conv(part, 8, 10).try_cast("int") <= 255)


def _group(part: Column) -> Column:
    return part.rlike("^[0-9a-f]{1,4}$")


def _dotted(value: Column) -> Column:
    """Four octets, all decimal, all hexadecimal or all octal (RFC 791 addresses as hosts read them)."""
    return (_parts(value, r"\.", 4, _octet) | _parts(value, r"\.", 4, _hex_octet)
            | _parts(value, r"\.", 4, _octal_octet))


def _number(value: Column) -> Column:
    """An address as one number of 32 bits."""
    decimal = value.rlike("^(0|[1-9][0-9]{0,9})$") & (value.try_cast("long") <= ADDRESS_MAX)
    return decimal | _hex_up_to(value, ADDRESS_MAX)


def _colons(value: Column) -> Column:
    """Eight groups, or six and a dotted address (RFC 4291, 2.2, without the short form)."""
    parts = F.split(value, ":")
    mixed = (F.size(parts) == 7) & F.forall(F.slice(parts, 1, 6), _group) & _parts(
        F.get(parts, F.lit(6)), r"\.", 4, _octet)
    return _parts(value, ":", 8, _group) | mixed


def ip_address(value: Column | str) -> Column:
    """Dotted decimal, hexadecimal or octal, one 32-bit number, IPv6 or IPv6 with a dotted tail."""
    text = F.lower(_text(value))
    return _holding(value, r"\d:", _sure(_dotted(text) | _number(text) | _colons(text)))


def host_name(value: Column) -> Column:
    """Two labels or more, the last one beginning with a letter; a closing dot is allowed."""
    labels = F.split(F.regexp_replace(value, r"\.$", ""), r"\.")
    return (F.size(labels) >= 2) & F.forall(labels, _label) & F.element_at(labels, -1).rlike("^[a-z]")


def _label(part: Column) -> Column:
    return (_made_of(part, LABEL_CHARACTERS) & (F.length(part) <= LABEL_MAX)
            & ~part.startswith("-") & ~part.endswith("-"))


def _host(value: Column) -> Column:
    return host_name(value) | _dotted(value) | _number(value) | _colons(value)


def _holding(value: Column | str, chars: str, cond: Column) -> Column:
    """``cond``, tried only where one of the characters it cannot do without occurs."""
    return F.when(_text(value).rlike(f"[{chars}]"), cond).otherwise(F.lit(False))


def url(value: Column | str) -> Column:
    """Host with optional scheme (http, https, ftp, ftps), port, path, query and fragment, separated
    as RFC 3986 does."""
    text = F.lower(_text(value))
    rest = F.regexp_replace(text, "^(https?|ftps?)://", "")
    authority = F.regexp_extract(rest, "^[^/?#]*", 0)
    tail = F.substr(rest, F.length(authority) + 1)
    host = F.regexp_replace(authority, ":[0-9]+$", "")
    good_host = _host(host) | _colons(authority)
    return _holding(value, r"\d.:", _sure(
        good_host & tail.rlike(r"^(/[^?#\s]*(\?[^#\s]*)?(#[^#\s]*)?)?$")))


def _address(text: Column) -> Column:
    name = F.regexp_extract(text, "^(.*)@[^@]*$", 1)
    host = F.lower(F.regexp_extract(text, "@([^@]*)$", 1))
    return F.forall(F.split(name, r"\."), lambda x: x.rlike(ATOM)) & _host(host)


def email(value: Column | str) -> Column:
    return _holding(value, "@", _sure(_address(_text(value))))


def email_list(value: Column | str) -> Column:
    """Addresses with one separator (white space, comma or semicolon) between; one may follow the
    last."""
    parts = F.split(_text(value), r"\s*[\s;,]\s*")
    kept = F.when(F.element_at(parts, -1) == "", F.slice(parts, F.lit(1), F.size(parts) - 1)
                  ).otherwise(parts)
    return _holding(value, "@", _sure((F.size(kept) > 0) & F.forall(kept, _address)))


def us_state(value: Column | str, territories: bool = True, military: bool = True) -> Column:
    codes = US_STATES + (US_TERRITORIES if territories else []) + (US_MILITARY if military else [])
    return _sure(F.upper(_text(value)).isin(codes))


def ca_province(value: Column | str) -> Column:
    return _sure(F.upper(_text(value)).isin(CA_PROVINCES))


def ca_postal_code(value: Column | str) -> Column:
    return whole(value, r"[A-Z][0-9][A-Z] [0-9][A-Z][0-9]")


def isbn(value: Column | str) -> Column:
    bare = _bare(value)

    def digit(i: int) -> Column:
        return F.substring(bare, i + 1, 1).try_cast("int")

    ten = F.lit(0)
    for i in range(9):
        ten = ten + digit(i) * (10 - i)
    ten = ten + F.when(F.upper(F.substring(bare, 10, 1)) == "X", 10).otherwise(digit(9))
    thirteen = F.lit(0)
    for i in range(13):
        thirteen = thirteen + digit(i) * (3 if i % 2 else 1)
    return _sure(F.when(F.length(bare) == 10, ten % 11 == 0)
                 .when(F.length(bare) == 13, thirteen % 10 == 0).otherwise(F.lit(False)))


def card_types(value: Column | str) -> Column:
    """Names of the card types whose number range fits, in a fixed order."""
    bare = _bare(value)
    return F.filter(F.array(*[F.when(bare.rlike(f"^{p}$"), F.lit(n)) for n, p in CARDS.items()]),
                    lambda n: n.isNotNull())


def credit_card(value: Column | str, kind: str) -> Column:
    """Number range and check digit of one card type; ``er`` cards have no check digit."""
    fits = _sure(_bare(value).rlike(f"^{CARDS[kind.lower()]}$"))
    return fits if kind.lower() == "er" else fits & luhn(value)


def cvv(value: Column | str, kind: str) -> Column:
    size = CVV_LENGTH.get(kind.lower())
    return whole(value, rf"\d{{{size}}}") if size else F.lit(False)


def _closes(digits: Column, n: int, weight) -> Column:
    """The digit behind the first ``n`` is their check digit modulo 11, weighted from the right."""
    digit = lambda i: F.substring(digits, i + 1, 1).try_cast("int")
    total = F.lit(0)
    for i in range(n):
        total = total + digit(i) * weight(n - 1 - i)
    return digit(n) == total * 10 % 11 % 10


def _tax_number(value: Column | str, formats: list[str], size: int, weight) -> Column:
    digits = F.regexp_replace(_text(value), "[^0-9]", "")
    mixed = F.translate(digits, "0123456789", "0000000000") == "0" * size
    varied = digits != F.repeat(F.substring(digits, 1, 1), F.lit(size))
    return number_format(value, formats) & _sure(
        mixed & varied & _closes(digits, size - 2, weight) & _closes(digits, size - 1, weight))


def br_cpf(value: Column | str) -> Column:
    """A person's tax number: nine digits and two check digits, not all alike."""
    return _tax_number(value, BR_CPF, 11, lambda k: k + 2)


def br_cnpj(value: Column | str) -> Column:
    """A company's tax number: twelve digits and two check digits, not all alike."""
    return _tax_number(value, BR_CNPJ, 14, lambda k: k % 8 + 2)
