"""Text helpers and the parser's patterns, written for Java regex.

Python and Java regex differ in three ways that matter here, handled by
inline flags: ``(?d)`` makes ``.``, ``^`` and ``$`` treat only ``\\n`` as a
line end (Python's rule), ``(?U)`` makes ``\\s``/``\\d`` Unicode-aware as
Python's ``str`` patterns are, and ``(?i)`` plus ``(?U)`` gives Unicode
case folding.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's for equal results).
# Python patterns, as written in the reference's parser:
HEAT_HEADER_PY = r"^(?:(Final\s+([ABC]))\s*(?:Event.*)?$|(Final)\s+Event)"   # IGNORECASE | MULTILINE
SWIMMER_LINE_PY = (r"^([=T]?\d+[=T]?)\s+(\d+)\s+(.+?)\s+(?:(0\.\d{2})\s+)?"
                   r"(\d+:\d{2}\.\d{2}|\d{2,3}\.\d{2})(?:\s+.*)?$")
CODE_SUFFIX_PY = r"\s+[A-Z]{2,8}(?:-[A-Z]{2,3})?\s*$"
SPLIT_ENTRY_PY = (r"(\d{2,3})m\s*(?:[\(﴾（]\d+[\)﴿）]\s*)?"
                  r"(\d+:\d{2}\.\d{2}|\d{2,3}\.\d{2})")
# Noise-line prefixes (IGNORECASE, matched at the start of the stripped line):
NOISE_PATTERNS_PY = [
    r"^Legend",
    r"^R\.T\.",
    r"^Timing",
    r"^SWM\d",
    r"^Record\s+Splits",
    r"^(?:WR|WC|CR|AR|US)\s+",
    r"^\d+:\d{2}\.\d{2}\s+\d+:\d{2}",
    r"^(?:Rank|NOC|Code|Points|Behind)",
    r"^Results",
    r"^R.sultats",
    r"^Name\s+(?:Club|NOC)",
    r"^Page\s+\d",
    r"^Report\s+Created",
    r"^FINA/",
    r"^Event\s+\d",
    r"^Final\s*[ABC]?\s*(?:Event|$)",
]
# Para-class marker in first names, case-sensitive substring search:
PARA_CLASS_PY = r"S\d|SB|SM"
# Short-course competition names (case-insensitive) for the optional filter:
SHORT_COURSE_PY = r"WORLD CUP|SHORT COURSE|25M"
# Competition names skipped by the link scraper (upper-cased substring test):
SKIP_COMPETITION_WORDS = ["25M", "SHORT COURSE"]
# Python's str.isspace() set, which str.strip()/split() use:
PY_SPACE_CLASS = (r"[\t\n\x{0B}\f\r\x{1C}-\x{1F} \x{85}\x{A0}\x{1680}\x{2000}-\x{200A}"
                  r"\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]")
# The same set as characters, derived from Python's own definition (all are below U+3001):
PY_SPACE_CHARS = "".join(ch for ch in map(chr, range(0x3001)) if ch.isspace())
# str.splitlines() boundaries:
EOL_PY = r"\r\n|[\n\r\x{0B}\f\x{1C}-\x{1E}\x{85}\x{2028}\x{2029}]"
SOFT_HYPHEN = "\u00ad"
# ---------------------------------------------------------------------------


def java_regex(py_pattern: str, flags: str = "") -> str:
    """Adapt a Python ``str`` pattern to Java: Unicode classes, ``\\n``-only line ends."""
    return f"(?{flags}dU){py_pattern}"


def java_regex_plain(py_pattern: str, flags: str = "") -> str:
    """The same for ASCII text (``is_plain``, ``is_ascii``), where Unicode classes and cases hold no other character: much cheaper."""
    return f"(?{flags}d){py_pattern}"


HEAT_HEADER = java_regex(HEAT_HEADER_PY, "im")
HEAT_HEADER_PLAIN = java_regex_plain(HEAT_HEADER_PY, "im")
SWIMMER_LINE = java_regex(SWIMMER_LINE_PY)
SWIMMER_LINE_PLAIN = java_regex_plain(SWIMMER_LINE_PY)
CODE_SUFFIX = java_regex(CODE_SUFFIX_PY)
SPLIT_ENTRY = java_regex(SPLIT_ENTRY_PY)
SPLIT_ENTRY_PLAIN = java_regex_plain(SPLIT_ENTRY_PY.replace("[\\(﴾（]", "\\(").replace("[\\)﴿）]", "\\)"))
# split_name as one match: a leading run of last-name tokens, then the rest.
NAME_PARTS = java_regex(rf"^((?:[A-Z][A-Z\-']+(?:{PY_SPACE_CLASS}+|$))*)(.*)$")
NAME_PARTS_PLAIN = java_regex_plain(r"^((?:[A-Z][A-Z\-']+(?:[\t-\r\x1C-\x20]+|$))*)(.*)$")
NOISE_LINE = java_regex("^(?:" + "|".join(p[1:] for p in NOISE_PATTERNS_PY) + ")", "i")

SECTION_MARK = "\u0001"


def py_strip(c: Column) -> Column:
    """``str.strip()``: remove Python whitespace at both ends (plain ``F.trim`` only removes spaces)."""
    return F.btrim(c, F.lit(PY_SPACE_CHARS))


def py_squash(c: Column) -> Column:
    """``" ".join(s.split())``: strip and collapse inner whitespace runs to one space."""
    squashed = F.regexp_replace(py_strip(c), f"{PY_SPACE_CLASS}+", " ")
    return F.when(c.rlike("[^!-~]"), squashed).otherwise(c)  # one printable ASCII token stays as it is


def is_plain(c: Column) -> Column:
    """Printable ASCII and ``\\n`` only."""
    return ~c.rlike(r"[^ -~\n]")


def is_ascii(c: Column) -> Column:
    """ASCII only (control characters too): the classes and cases of both kinds of pattern are then the same."""
    return F.octet_length(c) == F.length(c)


def splitlines(c: Column, plain: Column | None = None) -> Column:
    """``str.splitlines()``: no trailing empty element, empty text gives no line.  ``plain``: ``is_plain(c)``, if known."""
    parts = F.split(F.regexp_replace(c, f"(?:{EOL_PY})\\z", ""), EOL_PY, -1)  # the last line end closes a line, it opens none
    on_newline = F.split(F.when(c.endswith("\n"), F.substr(c, F.lit(1), F.length(c) - 1)).otherwise(c), "\n", -1)
    parts = F.when(is_plain(c) if plain is None else plain, on_newline).otherwise(parts)
    return F.when(c.isNull(), F.lit(None)).when(c == "", F.array().cast("array<string>")).otherwise(parts)


def soft_hyphen_to_dash(c: Column) -> Column:
    """Soft hyphen U+00AD becomes '-'."""
    return F.translate(c, SOFT_HYPHEN, "-")


def regex_contains(c: Column, pattern: str, ignore_case: bool = False) -> Column:
    """unanchored regex search; a missing value gives False (``na=False``)."""
    flags = "i" if ignore_case else ""
    return F.coalesce(c.rlike(java_regex(pattern, flags)), F.lit(False))


def last_path_element(c: Column) -> Column:
    """``url.split('/')[-1]``."""
    return F.substring_index(c, "/", -1)


def upper_contains(c: Column, word: str) -> Column:
    """``word in text.upper()``."""
    return F.upper(c).contains(word)
