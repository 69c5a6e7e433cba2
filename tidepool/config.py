"""Settings passed explicitly to the operators; nothing here is read from globals."""

from __future__ import annotations

from dataclasses import dataclass, field

# Tokens dropped from the index unless a caller passes its own list.
RESERVED_WORDS = (
    "abstract assert boolean break byte case catch char class const default do double else enum "
    "extends false final finally float for goto if implements import instanceof int interface long "
    "native new null package private protected public return short static strictfp super switch "
    "synchronized this throw throws transient true try void volatile while continue"
).split()
SPECIAL_CHARS = list("!@#$^&*()-+\\|/:-'\";")

# File extensions a crawl follows; the empty one means "no extension".
CRAWL_EXTENSIONS = ["java", "html", "asp", "js", "properties", "xml", "jsp", "sql", ""]


@dataclass(frozen=True)
class IndexConfig:
    """How text becomes an index.

    ``mode``           ``text`` indexes the visible text, ``raw`` the markup as it is.
    ``words_only``     keep words; otherwise single punctuation marks are terms as well.
    ``exclude_ci``     compare with the excluded list after lower-casing instead of before.
    ``docs_per_shard`` upper target for documents per shard, which bounds every postings array.
    ``block_bytes``    text bytes after which a new partial index (block) starts.
    """

    mode: str = "text"
    words_only: bool = True
    exclude_ci: bool = False
    excluded: tuple[str, ...] = field(default_factory=lambda: tuple(RESERVED_WORDS + SPECIAL_CHARS))
    separator: str = ";"
    docs_per_shard: int = 50_000
    block_bytes: int = 100_000
