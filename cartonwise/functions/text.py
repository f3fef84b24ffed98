"""Text cleaning and formatting."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


# Every white-space character, the no-break and wide spaces of typed cells among them.
WHITE_SPACE = "\t\n\v\f\r\x1c\x1d\x1e\x1f \x85\xa0\u1680\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a" \
              "\u2028\u2029\u202f\u205f\u3000"
# None of them is a character from ! to ~; texts compare as their bytes do.
_PRINTED = ("!", "\x7f")


def clean_text(cell: Column) -> Column:
    """Trim white space; the text "nan" is a missing value. Only a cell that begins or ends with a space, a control or a wide character
    is searched for white space, which takes longer than all else."""
    inner = cell.between(*_PRINTED) & F.substring(cell, -1, 1).between(*_PRINTED)
    return F.when(inner, F.when(cell != "nan", cell)).otherwise(F.nullif(F.trim(cell, F.lit(WHITE_SPACE)), F.lit("nan")))


def matching_key(name: Column) -> Column:
    """The form in which supplier names are compared across tables."""
    return F.lower(F.trim(name))


def like_contains(value: str) -> str:
    """LIKE pattern for part-text, with the wildcards in `value` taken literally."""
    for special in ("\\", "%", "_"):
        value = value.replace(special, "\\" + special)
    return f"%{value}%"


def split_emails(cell: Column) -> Column:
    """Addresses of a cell split at commas and semicolons, blanks and repeats dropped, order kept."""
    parts = F.transform(F.split(cell, "[,;]"), lambda e: F.trim(e))
    return F.array_distinct(F.filter(parts, lambda e: e != ""))


def file_safe(name: Column) -> Column:
    """Replace the characters that Windows forbids in file names."""
    return F.regexp_replace(name, r'[<>:"/\\|?*]', "_")


def carton_size(length: Column, width: Column, height: Column) -> Column:
    def side(c):
        return F.coalesce(c.cast("int"), F.lit(0)).cast("string")

    return F.concat_ws("×", side(length), side(width), side(height))


def joined(column: str) -> Column:
    """Aggregate: ordered, comma-joined text of a column's distinct values; null when there are none. As a DISTINCT
    aggregate its values are made distinct by hash before any group is collected, together with the distinct counts beside
    it; collect_set would turn the whole aggregation of the lines into a slower, sorting one."""
    kept = F.array_sort(F.expr(f"collect_list(DISTINCT {column})"))
    return F.when(F.size(kept) > 0, F.array_join(kept, ", "))
