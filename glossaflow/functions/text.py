r"""Native column functions for cleaning and classifying bilingual text.

White space, digits and word boundaries follow Unicode as Python's ``str`` and
``re`` do, which the JVM's defaults do not: ``SPACE`` lists the code points and
``(?U)`` is set where a boundary or a word character is asked for.
"""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values.
SPACE = r"[\t-\r\x1c-\x20\x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000]"
LATIN = "[A-Za-z]"
ARABIC = r"[\u0600-\u06ff\u0750-\u077f\u08a0-\u08ff]"
EASTERN_DIGITS = "٠١٢٣٤٥٦٧٨٩۰۱۲۳۴۵۶۷۸۹"
WESTERN_DIGITS = "01234567890123456789"

#: The characters of SPACE.
SPACES = "".join(c for c in map(chr, range(0x3001)) if re.match(SPACE, c))

# The values down to ENTITIES are fixed, too.

#: Most digits of an entry number.
NUMBER_DIGITS = {"v2": 4, "v3": 5, "v4": 5}

#: Substitutions in Latin text, in order.
OCR_FIXES = {
    "v2": ((r"(?U)\b0([a-z])", "o$1"), (r"(?U)([a-z])0\b", "$1o"), (r"\|", "l")),
    "v3": ((r"(?U)\b0([a-z])", "o$1"), (r"(?U)([a-z])0\b", "$1o"), (r"\|([a-z])", "l$1"), (r"([a-z])\|", "$1l"), (r"(?U)\brn\b", "m"), (r"(?U)\bcl\b", "d")),
    "v4": ((r"(?U)\b0([a-z])", "o$1"), (r"(?U)([a-z])0\b", "$1o"), (r"\|([a-z])", "l$1"), (r"([a-z])\|", "$1l")),
}

#: Letters that fold, then marks that go (no target).
FOLD_FROM = "\u0622\u0623\u0625\u0624\u0626\u0649\u0670\u064b\u064c\u064d\u064e\u064f\u0650\u0651\u0652"
FOLD_TO = "\u0627\u0627\u0627\u0648\u064a\u064a"

#: What a chapter heading begins with.
CHAPTER_PATTERNS = (
    "^(مضادات|أدوية|فيتامينات|هرمونات|مستحضرات|أشربة|مراهم|قطرات|تحاميل|لصقات|حقن)",
    "^(الفصل|باب|القسم)" + SPACE,
)

ENTITIES = (("&nbsp;", "\u00a0"), ("&quot;", '"'), ("&#39;", "'"), ("&apos;", "'"), ("&middot;", "·"), ("&copy;", "©"), ("&lt;", "<"), ("&gt;", ">"), ("&amp;", "&"))


def strip(text: Column) -> Column:
    """White space off both ends."""
    return F.btrim(text, F.lit(SPACES))


def collapse(text: Column) -> Column:
    return F.regexp_replace(text, f"{SPACE}+", " ")


def condense(text: Column) -> Column:
    """Collapsed, and none at the ends: blanks only are left to be trimmed."""
    return F.trim(collapse(text))


def clean(text: Column) -> Column:
    """Null as empty, hard spaces as spaces, zero-width marks out, runs of
    white space as one space, none at the ends."""
    return F.btrim(collapse(F.translate(F.coalesce(text, F.lit("")), "\u00a0\u200b\u200f", " ")))


def strip_html(html: Column) -> Column:
    """The text of a page: no scripts, styles or links, entities resolved."""
    text = F.regexp_replace(F.coalesce(html, F.lit("")), r"(?is)<script\b[^>]*>.*?</script\s*>|<style\b[^>]*>.*?</style\s*>|<!--.*?-->", " ")
    text = F.regexp_replace(text, r"(?s)<[^>]*>", " ")
    return clean(reduce(lambda t, e: F.replace(t, F.lit(e[0]), F.lit(e[1])), ENTITIES, text))


# Blocks of letters in the shapes they have within words, marks of
# direction, and what is left of glyphs without a character.
FORMS = ("\ufb50", "\ufeff")
FORM = r"[\ufb50-\ufdff\ufe70-\ufeff]"
DIRECTIONS = "\u061c\u200e\u200f\u202a\u202b\u202c\u202d\u202e\u2066\u2067\u2068\u2069"
CID = r"\(cid:[0-9]+\)"


def presentation_forms(text: Column) -> Column:
    """Letters in the shapes of their places in words, and ligatures of up to
    eighteen letters, as the letters they stand for.

    Each is replaced by its compatibility decomposition, composed; what comes of
    neighbours is not composed with each other. Others stay, null stays null. A
    text is cut at those only that stand for several letters, and each is found
    by its place in a table.
    """
    low, high = map(ord, FORMS)
    whole = {c: unicodedata.normalize("NFKC", c) for c in map(chr, range(low, high + 1)) if re.match(FORM, c)}
    # One letter for one needs no cut; the others are few in a text.
    single = {c: into for c, into in whole.items() if len(into) == 1 and into != c}
    # Between the two blocks the table has what must not change.
    table = F.split(F.lit("\x1f".join(whole.get(chr(c), chr(c)) for c in range(low, high + 1))), "\x1f", -1)

    def spelled(piece: Column) -> Column:
        at = F.ascii(piece) - low
        return F.when(at.between(0, high - low) & (F.char_length(piece) == 1), F.get(table, at)).otherwise(piece)

    def cut(left: Column) -> Column:
        pieces = F.split(left, f"(?<={FORM})|(?={FORM})", -1)
        return F.when(left.rlike(FORM), F.array_join(F.transform(pieces, spelled), "")).otherwise(left)

    # What a letter becomes is no letter of these blocks. In a list of one, so
    # that it is worked out once.
    left = F.translate(text, "".join(single), "".join(single.values()))
    return F.get(F.transform(F.array(left), cut), F.lit(0))


def normalize_forms(text: Column) -> Column:
    """Text of a file's own text layer: no marks of direction, no numbers of
    nameless glyphs, letters for their shapes."""
    return presentation_forms(F.regexp_replace(F.translate(text, DIRECTIONS, ""), CID, ""))


def safe_name(name: Column) -> Column:
    """A name fit for a file: other characters as ``_``, dots single."""
    kept = F.regexp_replace(name, r"(?U)[^\w\u0600-\u06ff\u0750-\u077f\-. ]+", "_")
    return F.regexp_replace(strip(F.regexp_replace(kept, r"\.{2,}", ".")), "[._]+$", "")


def note_name(stem: Column) -> Column:
    """The file name of a source's note: spaces and slashes as ``_``."""
    return F.translate(stem, " /", "__")


def archive_name(name: Column) -> Column:
    """The folder name of an archive: as above, brackets left out."""
    return F.translate(name, " /\\()", "___")


def has_latin(text: Column, pattern: str = LATIN) -> Column:
    return text.rlike(pattern)


def has_arabic(text: Column, pattern: str = ARABIC) -> Column:
    return text.rlike(pattern)


def is_number(text: Column, profile: str = "v2") -> Column:
    return text.rlike(rf"(?U)^\d{{1,{NUMBER_DIGITS[profile]}}}$")


def number(text: Column) -> Column:
    """The value of Western or Eastern Arabic digits, else null."""
    return F.translate(text, EASTERN_DIGITS, WESTERN_DIGITS).try_cast("bigint")


def classify(text: Column, profile: str = "v2", latin: str = LATIN, arabic: str = ARABIC) -> Column:
    """digit, mixed, arabic, english or noise, in this order."""
    one, two = has_latin(text, latin), has_arabic(text, arabic)
    return F.when(is_number(text, profile), "digit").when(one & two, "mixed").when(two, "arabic").when(one, "english").otherwise("noise")


def latin_part(text: Column) -> Column:
    return strip(F.regexp_replace(text, r"[^A-Za-z .;,\-]", ""))


def arabic_part(text: Column) -> Column:
    return strip(F.regexp_replace(text, rf"[^{ARABIC[1:-1]} .;,\-]", ""))


def fix_ocr(text: Column, profile: str = "v2") -> Column:
    return reduce(lambda t, fix: F.regexp_replace(t, *fix), OCR_FIXES[profile], text)


def _untailed(text: Column) -> Column:
    """A mark that stands by itself at the end off, and white space off both
    ends. White space is plain blanks here, so no pattern is needed."""
    body = F.rtrim(text)
    return F.trim(F.when(F.right(body, F.lit(2)).isin(" .", " ,", " ;", " :"), F.left(body, F.char_length(body) - 1)).otherwise(text))


def clean_arabic(text: Column, profile: str = "v2") -> Column:
    marks = "\u200e\u200f" if profile == "v2" else "\u200e\u200f\u200d\u200c"
    out = F.translate(condense(text), marks, "")
    return F.trim(out) if profile == "v2" else _untailed(out)


def clean_english(text: Column) -> Column:
    return _untailed(condense(text))


def normalize_arabic(text: Column) -> Column:
    return strip(F.translate(text, FOLD_FROM, FOLD_TO))


def count_of(text: Column, letters: str) -> Column:
    """How many characters of a class a text holds: what it loses without
    them, so that no list of matches is made."""
    return F.length(text) - F.length(F.regexp_replace(text, f"{letters}+", ""))


def garble_counts(text: Column) -> dict[str, Column]:
    """What :func:`is_garbled` counts in a text, as columns to be added where
    several of its profiles are asked for."""
    runs = {
        "marks": r"[\u064b-\u0652]{2,}",
        "words": r"[\u0621-\u063a\u0641-\u064a]{2,}",
    }
    classes = {
        "odd": r"[\u0640\u064b-\u065f\u0670-\u06ff]",
        "odd_loose": r"[\u0640-\u065f\u0670-\u06ff]",
        "letters": r"[\u0621-\u063a\u0641-\u064a]",
        "forms": r"[\ufb50-\ufdff\ufe70-\ufeff]",
    }
    counted = {k: F.regexp_count(text, F.lit(p)) for k, p in runs.items()} | {k: count_of(text, p) for k, p in classes.items()}
    return {"length": F.length(text), **counted}


def is_garbled(text: Column | dict[str, Column], threshold: float = 0.15, *, presentation: bool = True, strict: bool = False) -> Column:
    """Whether a text layer of 50 characters or more is wrongly encoded, from
    the text or its :func:`garble_counts`.

    ``presentation`` also counts presentation forms (off for the incremental
    profile). ``strict`` leaves ordinary letters out of the class of odd
    characters, which otherwise holds U+0641 to U+064A, too.
    """
    held = text if isinstance(text, dict) else garble_counts(text)
    marks, words, letters = (held[k].cast("double") for k in ("marks", "words", "letters"))
    odd = held["odd" if strict else "odd_loose"].cast("double")
    garbled = (F.greatest(words, F.lit(1.0)) * threshold < marks) if presentation else (words > 0) & (marks / F.nullif(words, F.lit(0.0)) > threshold)
    if presentation:
        garbled = garbled | (held["forms"] > 5)
    garbled = garbled | ((letters > 0) & (odd / F.nullif(letters, F.lit(0.0)) > 0.5))
    return F.coalesce((held["length"] >= 50) & F.coalesce(garbled, F.lit(False)), F.lit(False))


def content_type(text: Column, *, chapters: tuple[str, ...] = CHAPTER_PATTERNS, letters: str = ARABIC, bullets: bool = True) -> Column:
    """chapter, section, list_item, table or content."""
    line = strip(F.coalesce(text, F.lit("")))
    chapter = reduce(lambda a, b: a | b, (line.rlike(p) for p in chapters))
    item = line.rlike(r"(?U)^\d+[.)_]")
    item = item | line.rlike(r"^[-•*]") if bullets else item
    return (
        F.when(line == "", "content")
        .when(chapter, "chapter")
        .when(line.rlike(letters) & (F.length(line) < 60) & line.endswith(":"), "section")
        .when(item, "list_item")
        .when(line.contains("|") | line.contains("\t"), "table")
        .otherwise("content")
    )


def split_columns(raw: Column, *, strict: bool = False) -> tuple[Column, Column]:
    """(term, definition) of a line. The line is cleaned first, so that no gap
    is left to split at, unless ``strict`` splits the raw line."""
    if not strict:
        return clean(raw), F.lit("")
    parts = F.split(strip(raw), rf"{SPACE}{{2,}}|\t", 2)
    return clean(parts[0]), F.coalesce(clean(F.try_element_at(parts, F.lit(2))), F.lit(""))


def words(text: Column) -> Column:
    """Tokens between white space."""
    return F.array_remove(F.split(text, f"{SPACE}+"), "")


def is_safe_category(text: Column) -> Column:
    return text.rlike(r"(?U)^[\w\-\u0600-\u06ff]+$")


def pad_right(text: Column, width: int, cut: int) -> Column:
    return F.rpad(F.substring(text, 1, cut), width, " ")
