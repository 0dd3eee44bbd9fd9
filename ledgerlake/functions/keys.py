"""Hash-key expressions of the vault (MD5, 32 lower-case hex digits).

All four are plain Column expressions, so they stay inside whole-stage codegen.
Postgres ``concat`` skips NULL arguments; Spark ``concat`` returns NULL when
any argument is NULL while ``concat_ws`` skips them, so the NULL-skipping
forms are written with ``concat_ws('', ...)``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ColumnOrName = Column | str


def _c(col: ColumnOrName) -> Column:
    return F.col(col) if isinstance(col, str) else col


def as_text(col: ColumnOrName) -> Column:
    """Text form used inside hashes.  Money must already be decimal so that
    Spark and Postgres/DuckDB render it alike (doubles render differently)."""
    return _c(col).cast("string")


def hash_key(col: ColumnOrName) -> Column:
    """Business-key hash: md5 of the upper-cased, space-trimmed text; NULL stays NULL."""
    return F.md5(F.upper(F.trim(as_text(col))))


def hash_diff(*cols: ColumnOrName) -> Column:
    """Change-detection hash over attributes: NULL-skipping concat, no delimiter."""
    return F.md5(F.concat_ws("", *[as_text(c) for c in cols]))


def link_hash_key(*hash_keys: ColumnOrName) -> Column:
    """Link key: md5 of the concatenated hub keys (a NULL side is skipped)."""
    return F.md5(F.concat_ws("", *[as_text(c) for c in hash_keys]))


def surrogate_key(hub_key: ColumnOrName, load_dts: ColumnOrName) -> Column:
    """Dimension version key: md5 of the hub key followed by the load time text
    (``yyyy-MM-dd HH:mm:ss[.ffffff]``)."""
    return F.md5(F.concat_ws("", as_text(hub_key), as_text(load_dts)))


#: Zero bytes behind a key that is not a digest, so that its packed form never has a digest's 16 bytes.
_PLAIN = 17


def packed(col: ColumnOrName) -> Column:
    """A key in the form it is shuffled in: an MD5 digest as its 16 bytes, any other text as
    its own bytes and a mark.  One to one, so packed keys can be joined and grouped;
    :func:`unpacked` gives the key back."""
    c = _c(col)
    raw = F.unhex(c)
    digest = (F.length(c) == 32) & (F.lower(c) == c) & raw.isNotNull()
    return F.when(digest, raw).otherwise(F.concat(F.encode(c, "UTF-8"), F.lit(bytes(_PLAIN))))


def is_key(name: str) -> bool:
    return name.startswith("hk_") or name.endswith("_key") or name == "hash_diff"


def packed_keys(df: DataFrame, joined: str | None = None) -> DataFrame:
    """``df`` with its text keys packed.  With ``joined``, a key that rows without it cannot be joined on: they go first
    and the packed key is not nullable, as a NULL test of it would pack the key again, several times."""
    text = {c for c, t in df.dtypes if t == "string" and is_key(c)}

    def pack(c):
        return F.coalesce(packed(c), F.lit(b"")) if c == joined else packed(c)
    rows = df if joined is None else df.where(F.col(joined).isNotNull())
    return rows.select(*[pack(c).alias(c) if c in text else c for c in df.columns])


def unpacked_keys(df: DataFrame) -> DataFrame:
    """``df`` with its packed keys (binary columns) as text again."""
    return df.select(*[unpacked(c).alias(c) if t == "binary" else c for c, t in df.dtypes])


def key_text(df: DataFrame, name: str) -> Column:
    """The key ``name`` of ``df`` as text, whether it is packed or not."""
    return unpacked(name) if dict(df.dtypes)[name] == "binary" else F.col(name)


def unpacked(col: ColumnOrName) -> Column:
    """The key behind :func:`packed`."""
    c = _c(col)
    return (F.when(F.length(c) == 16, F.lower(F.hex(c)))
            .otherwise(F.decode(F.substring(c, F.lit(1), F.length(c) - _PLAIN), "UTF-8")))
