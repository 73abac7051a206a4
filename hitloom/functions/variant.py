"""Path extraction and hashing on variant (semi-structured) columns."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from hitloom.spec import DATE, DATE_FORMAT, VAR

ColumnOrName = Column | str


def _c(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def vget(src: ColumnOrName, path: str, type_: str, strict: bool = True) -> Column:
    """``src:path::type``.  Missing paths give NULL.  With ``strict`` a value
    that cannot be cast raises (INVALID_VARIANT_CAST); otherwise it is NULL.
    Dates are parsed from ``yyyyMMdd`` text."""
    src = _c(src)
    if type_ == DATE:
        text = vget(src, path, "string", strict)
        return F.to_date(text, DATE_FORMAT) if strict else F.try_to_date(text, DATE_FORMAT)
    fn = F.variant_get if strict else F.try_variant_get
    return fn(src, path, type_)


def vtext(src: ColumnOrName, path: str) -> Column:
    """Value at ``path`` as text, for grouping and comparison (a variant can
    be neither grouped nor compared with ``=``)."""
    return F.try_variant_get(_c(src), path, "string")


def vpresent(src: ColumnOrName, path: str) -> Column:
    """The value at ``path`` kept as a variant: ``count`` of it counts
    presence, so ``false`` and JSON ``null`` are counted too."""
    return F.variant_get(_c(src), path, VAR)


def content_hash(src: ColumnOrName) -> Column:
    """Hash of a whole document as text.

    ``to_json`` of a variant lists object keys in sorted order, so documents
    that differ only in key order hash equal.  Values are xxhash64; only
    equality of hashes is used."""
    return F.xxhash64(F.to_json(_c(src))).cast("string")
