"""Row-wise text functions (P1–P7, F1, F4). All are native Catalyst
expressions: they run inside whole-stage codegen and work unchanged on
streaming DataFrames."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# --- fixed values -----------------------------------------------------------
# Byte-level BPE pre-tokenizer pattern (contractions, letter runs with an
# optional leading space, digit runs, other symbols, whitespace runs).
PRETOKEN_PATTERN = (
    r"(?U)'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+")
# Markers removed from two 2008 news files before XML parsing.
HEADLINE_CLOSE = "</hl"
HEADLINE_OPEN_AT_END = "<hl>"
# Stand-in for a bare ampersand while a segment file is parsed as XML.
AMP_PLACEHOLDER = "__amp__"
# Corpus file name: pair, split, language, optional encoded suffix.
CORPUS_NAME_PATTERN = r"^(en-..)\.([^.]+)\.(..)(\.sp)?$"
# Whitespace removed by Python's str.strip(): Unicode white space plus the
# four information separators U+001C..U+001F.
STRIP_PATTERN = r"(?U)^[\s\x{1c}-\x{1f}]+|[\s\x{1c}-\x{1f}]+$"
# Marks the places where a text is cut into parts for pre-tokenizing.
PART_MARK = "\ue000"
# -----------------------------------------------------------------------------


def _c(col) -> Column:
    return col if isinstance(col, Column) else F.col(col)


def normalize_newlines(col) -> Column:
    """CRLF to LF (``dos2unix``)."""
    return F.regexp_replace(_c(col), "\r\n", "\n")


def headline_junk(col) -> Column:
    """P2 predicate: a line holding ``</hl`` or ending in ``<hl>``."""
    c = _c(col)
    return c.contains(HEADLINE_CLOSE) | c.endswith(HEADLINE_OPEN_AT_END)


def protect_amp(col) -> Column:
    """Every ``&`` to the placeholder, so a bare ampersand parses."""
    return F.replace(_c(col), F.lit("&"), F.lit(AMP_PLACEHOLDER))


def restore_amp(col) -> Column:
    """P3 inverse: placeholder back to ``&``; entities stay as written."""
    return F.replace(_c(col), F.lit(AMP_PLACEHOLDER), F.lit("&"))


def strip_text(col) -> Column:
    """Python ``str.strip()`` — all leading/trailing Unicode white space."""
    return F.regexp_replace(_c(col), STRIP_PATTERN, "")


def language_tag(lang_col) -> Column:
    """P5 tag text ``<2xx> ``."""
    return F.concat(F.lit("<2"), _c(lang_col), F.lit("> "))


def tag_line(line_col, tgt_lang_col) -> Column:
    return F.concat(language_tag(tgt_lang_col), _c(line_col))


def corpus_name_part(name_col, part: str) -> Column:
    """``pair`` / ``split`` / ``lang`` / ``encoded`` from ``en-de.train.de[.sp]``."""
    idx = {"pair": 1, "split": 2, "lang": 3, "encoded": 4}[part]
    v = F.regexp_extract(_c(name_col), CORPUS_NAME_PATTERN, idx)
    if part == "encoded":
        return v == F.lit(".sp")
    return F.when(v != "", v)


def basename(path_col) -> Column:
    return F.regexp_extract(_c(path_col), r"([^/]*)$", 1)


def pretokenize(col) -> Column:
    """byte-level BPE pre-tokens of a line, no added prefix space."""
    return F.regexp_extract_all(_c(col), F.lit(PRETOKEN_PATTERN), 0)


def pretoken_parts(col) -> Column:
    """Parts of a text whose pre-tokens, one part after the other, are those of
    the text. It is cut before every space: after other characters than white
    space a space can only begin a pre-token, and none looks back. A text with
    white space before a space, or with the mark itself, is one part."""
    c = _c(col)
    whole = c.rlike(r"(?U) (?<=\s )") | c.contains(PART_MARK)
    return F.when(whole, F.array(c)).otherwise(F.split(F.replace(c, F.lit(" "), F.lit(PART_MARK + " ")), PART_MARK))


def join_pieces(col) -> Column:
    """pieces joined by one space."""
    return F.array_join(_c(col), " ")


def split_lines(text_col, newline: str = "lf") -> Column:
    """Lines of a text value. ``lf`` splits on ``\\n`` only (grep/sed/cat);
    ``universal`` also ends a line at ``\\r\\n`` and a lone ``\\r``."""
    sep = {"lf": "\n", "universal": "\r\n|\r|\n"}[newline]
    return F.split(_c(text_col), sep, -1)
