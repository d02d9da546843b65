"""Text cells: stripping, key folding, file names. Null in, null out unless said otherwise."""

from __future__ import annotations

import unicodedata

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql.functions import arrow_udf

#: Unicode white space, as one class that Java's and RE2's expressions read alike.
SPACE = r"[\x09-\x0D\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
#: The same characters, one after the other.
SPACES = "".join(map(chr, [*range(0x09, 0x0E), *range(0x1C, 0x21), 0x85, 0xA0, 0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000]))
#: Stands between cells that are folded together: a private character without white space, marks or other forms.
BETWEEN = "\ue000"
#: Prefixes of file names that a run may have put there.
STATUS_PREFIXES = ("FAILED_", "possible_duplicate_", "Copy of ")
FAILED, DUPLICATE = STATUS_PREFIXES[:2]


def strip(c: Column) -> Column:
    """Without white space at both ends; null becomes an empty text."""
    return F.trim(F.coalesce(c, F.lit("")), F.lit(SPACES))


def clean_cell(c: Column) -> Column:
    """As strip, and no-break spaces inside become plain ones: what a de-duplicated table shows."""
    return F.replace(strip(c), F.lit("\u00a0"), F.lit(" "))


def json_text(c: Column) -> Column:
    """A text as JSON."""
    return F.regexp_extract(F.to_json(F.struct(c.cast("string").alias("x"))), r'(?s)^\{"x":(.*)\}$', 1)


def collapse(c: Column) -> Column:
    """Each run of white space as one space."""
    return F.regexp_replace(c, f"{SPACE}+", " ")


def blank_to_null(c: Column) -> Column:
    return F.nullif(strip(c), F.lit(""))


def canonical_header(c: Column) -> Column:
    return F.lower(strip(c))


def folded_text(x: str) -> str:
    """The fold of one text, for names of columns."""
    bare = "".join(c for c in unicodedata.normalize("NFKD", x) if unicodedata.category(c) != "Mn")
    return " ".join("".join(c for c in unicodedata.normalize("NFKC", bare) if unicodedata.category(c) != "Cf").split())


def _folded(x: pa.Array) -> pa.Array:
    """Compatibility forms without accents and format marks. Spark has no built-in Unicode normalisation."""
    bare = pc.replace_substring_regex(pc.utf8_normalize(x, form="NFKD"), r"\p{Mn}", "")
    return pc.replace_substring_regex(pc.utf8_normalize(bare, form="NFKC"), r"\p{Cf}", "")


def fold(c: Column) -> Column:
    """The form in which cells are compared: folded, white space collapsed and stripped; null is empty.

    Only texts with a character outside of ASCII go to Python.
    """
    s = strip(c)
    odd = arrow_udf(_folded, "string")(F.when(s.rlike(r"[^\x00-\x7F]"), s))
    return strip(collapse(F.coalesce(odd, s)))


def folded_cells(cells: Column) -> Column:
    """fold of each text of an array, in one call."""
    return F.transform(F.split(fold(F.array_join(F.transform(cells, lambda c: F.coalesce(c, F.lit(""))), BETWEEN)), BETWEEN, -1), strip)


def title_key(c: Column) -> Column:
    """The fold's letters and digits, lower-case."""
    return F.lower(F.regexp_replace(fold(c), r"[^\p{L}\p{N}]", ""))


def clean_line(line: Column, line_no: Column) -> Column:
    """One line of a raw text file; null where the line is to be dropped (empty, or a separator hint on line 0)."""
    bare = F.regexp_replace(strip(line), r"^\x{FEFF}+", "")
    hint = (line_no == 0) & F.lower(bare).startswith("sep=")
    return F.when((bare != "") & ~hint, collapse(bare))


def base_name(c: Column) -> Column:
    """A file name without its last extension; leading dots begin no extension."""
    return F.regexp_replace(c, r"^(\.*[^.].*)\.[^.]*$", "$1")


def without_status(c: Column) -> Column:
    """A file name without one status prefix, in any case; as it was if nothing would remain."""
    rest = F.regexp_replace(c, f"^(?i:{'|'.join(STATUS_PREFIXES)})", "")
    return F.when(rest == "", c).otherwise(rest)


def year_of_name(c: Column) -> Column:
    """The year that a file name begins with, else null."""
    return F.nullif(F.regexp_extract(c, r"^([0-9]{4})[-_]", 1), F.lit(""))


_DATE = r"([0-9]{4}-[0-9]{2}-[0-9]{2})"


def date_venue(c: Column) -> Column:
    """Struct (set_date, venue) of a base name "date venue"; both null if it is not of that form."""
    form = rf"(?s)^{_DATE}{SPACE}+(.+)$"
    got = lambda k: F.regexp_extract(strip(c), form, k)
    return F.struct(F.nullif(got(1), F.lit("")).alias("set_date"), F.nullif(got(2), F.lit("")).alias("venue"))


def date_title(c: Column) -> Column:
    """Struct (date, title): a date prefix, separators dropped; an empty date and the whole name if there is none."""
    form = rf"^{_DATE}[-_ ]*(.*)"
    date = F.regexp_extract(c, form, 1)
    return F.struct(date.alias("date"), F.when(date == "", c).otherwise(F.regexp_extract(c, form, 2)).alias("title"))


def failed_name(c: Column) -> Column:
    """The name that a file gets when its processing failed."""
    return F.concat(F.lit(FAILED), c)


def archive_entry(path: Column) -> Column:
    """Struct (set_date, venue, source_file) of a workbook's path in an archive; set_date null if it is not one."""
    name = F.substring_index(path, "/", -1)
    form = rf"(?s)^{_DATE}{SPACE}*(.*?)\.(?i:xlsx)$"
    venue = F.regexp_replace(strip(F.regexp_extract(name, form, 2)), r"^[-_ ]+", "")
    return F.struct(
        F.nullif(F.regexp_extract(name, form, 1), F.lit("")).alias("set_date"),
        F.coalesce(F.nullif(venue, F.lit("")), F.lit("Unknown")).alias("venue"),
        F.regexp_replace(name, r"\.[^.]*$", "").alias("source_file"),
    )


def text_cell(c: Column) -> Column:
    """A cell that a spreadsheet keeps as text; an empty one stays empty."""
    return F.when(c == "", c).otherwise(F.concat(F.lit("'"), c))


def base_url(c: Column) -> Column:
    """A service's address without the slashes at its end."""
    return F.regexp_replace(strip(c), "/+$", "")


def hyperlink(url: Column, name: Column) -> Column:
    """A link formula; quotes inside are doubled."""
    quoted = lambda c: F.replace(c, F.lit('"'), F.lit('""'))
    return F.format_string('=HYPERLINK("%s", "%s")', quoted(url), quoted(name))
