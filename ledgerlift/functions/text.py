"""Text functions of receipts and label corpora (F-01 to F-10, F-19, F-20, CER), as column expressions."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

#: Fixed value: units that may stand between a count and an item name, in the order in which they are tried.
UNITS = ("bungkus", "renceng", "sachet", "batang", "lembar", "kaleng", "toples", "karung", "piring", "keping", "liter", "botol", "galon", "lusin", "butir", "papan", "sisir", "kotak", "meter", "gelas", "ikat", "biji", "buah", "pack", "roll", "slop", "cup", "dus", "bks", "pcs", "pak", "sct", "box", "rim", "sak", "set", "ons", "ltr", "ekor", "kg", "gr", "ml", "lt", "pc")
PLACEHOLDERS = ("objects", "object")


def count_pattern(strict: bool = False) -> str:
    """A count, an optional unit, a name. strict: a unit must end at a word boundary, so that it can't eat a name."""
    unit = rf"(?:({'|'.join(UNITS)})\b)?" if strict else f"({'|'.join(UNITS)})?"
    return rf"(?i)^\s*(\d{{1,3}})\s*{unit}\.?\s*(?=\D)(.+)$"


def to_int(text: Column) -> Column:
    """All ASCII digits as one number (signs, decimal and thousands marks vanish); null if there are none."""
    return F.when(text.rlike("[0-9]"), F.regexp_replace(text, "[^0-9]+", "").try_cast("decimal(38,0)"))  # a failed cast costs an exception


def is_number(text: Column) -> Column:
    """Whether what is left of letters and digits is digits only."""
    return F.regexp_replace(F.lower(text), "[^0-9a-z]", "").rlike("^[0-9]+$")


def normalise(text: Column) -> Column:
    return F.regexp_replace(F.lower(text.cast("string")), "[^0-9a-z]", "")


def has_digit(text: Column) -> Column:
    return text.rlike(r"\p{Nd}")


def split_count(text: Column, strict: bool = False) -> Column:
    """struct(count, name) of a text in which a count is welded to an item name; null otherwise.

    By default a unit may be cut off the front of a longer word, as the source system does; see `count_pattern`.
    """
    pattern = count_pattern(strict)
    name = F.trim(F.regexp_extract(text, pattern, 3))
    letters = F.length(F.regexp_replace(F.lower(name), "[^a-z]", ""))
    starts = text.rlike(r"^\s*\d{1,3}\D")  # so begins all that fits; the units are tried on nothing else
    fits = starts & text.rlike(pattern) & name.rlike(r"^\p{L}") & (letters >= 3) & ~F.lower(name).isin(*UNITS)
    return F.when(fits, F.struct(F.regexp_extract(text, pattern, 1).try_cast("int").alias("count"), name.alias("name")))


def source_id(file_name: Column) -> Column:
    """The receipt that an augmented copy comes from: what precedes '_jpg.rf.', else the whole name."""
    pattern = r"^(.*?)_jpg\.rf\."
    return F.when(file_name.rlike(pattern), F.regexp_extract(file_name, pattern, 1)).otherwise(file_name)


def cer(pred: Column, gold: Column) -> Column:
    """Character error rate: edit distance by the gold length, which counts as one at least."""
    return F.levenshtein(pred, gold) / F.greatest(F.length(gold), F.lit(1))


def thousands(number: Column) -> Column:
    """15000 as '15.000'."""
    return F.translate(F.format_number(number, 0), ",", ".")


def is_label(text: Column) -> Column:
    """Not blank and no placeholder class."""
    return (F.trim(text) != "") & ~F.trim(text).isin(*PLACEHOLDERS)


def jittered_price(base: Column, factor: Column, step: int = 500, least: int | None = None) -> Column:
    """base x factor cut down to whole steps; where nothing would be left the base itself, or `least` at least if given."""
    if least is not None:
        return F.greatest(F.lit(least).cast("bigint"), (F.floor(base * factor / step) * step).cast("bigint"))
    return F.coalesce(F.nullif((F.floor(base * factor / step) * step).cast("bigint"), F.lit(0)), base.cast("bigint"))
