"""Hash-key and hash-diff column builders.

All of them return Columns, so the hashes are computed inside the scan stage
by whole-stage codegen; no Python runs per row.

Recipe (fixed values that must equal the modelled warehouse):
  hash key      SHA-256 of UPPER(TRIM(key)); composite keys joined by '|'
                in the declared order; a NULL part makes the whole key NULL.
  hash diff     SHA-256 of the payload columns, each COALESCE(col, ''),
                joined by '|', no trimming and no upper-casing.
  digest        lower-case hex string (MD5 selectable).
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed values of the recipe.
KEY_DELIMITER = "|"
NULL_REPLACEMENT = ""
DEFAULT_ALGO = "sha256"

ColumnOrName = Column | str


def _col(c: ColumnOrName) -> Column:
    return F.col(c) if isinstance(c, str) else c


def digest(text: Column, algo: str = DEFAULT_ALGO) -> Column:
    """Hex digest of a string column."""
    algo = algo.lower()
    if algo in ("sha256", "sha2_256", "sha2"):
        return F.sha2(text, 256)
    if algo == "md5":
        return F.md5(text)
    raise ValueError(f"unsupported hash algorithm {algo!r}")


def normalise_key(c: ColumnOrName) -> Column:
    """Business-key normal form: cast to string, trim blanks, upper-case."""
    return F.upper(F.trim(_col(c).cast("string")))


def _join(parts: list[Column]) -> Column:
    if len(parts) == 1:
        return parts[0]
    seq: list[Column] = []
    for i, p in enumerate(parts):
        if i:
            seq.append(F.lit(KEY_DELIMITER))
        seq.append(p)
    # concat (not concat_ws): a NULL part nulls the result, as string '+' does.
    return F.concat(*seq)


def hash_key(*cols: ColumnOrName, algo: str = DEFAULT_ALGO) -> Column:
    """Hash key of one business key or of a composite key in fixed order."""
    if not cols:
        raise ValueError("hash_key needs at least one column")
    return digest(_join([normalise_key(c) for c in cols]), algo)


def pack(c: ColumnOrName) -> Column:
    """A string column as bytes that ``unpack`` turns back: a lower-case hex digest
    takes half its length, other text one byte more.

    Hash keys go packed through shuffles, whose compression finds nothing in hex digits.
    Equal texts stay equal, digests sort among themselves as their texts do, and so do other texts."""
    text = _col(c)
    raw = F.unhex(text)
    is_digest = F.length(text).isin(32, 64) & (F.lower(F.hex(raw)) == text)
    return F.when(is_digest, F.concat(F.lit(b"\x01"), raw)).otherwise(F.concat(F.lit(b"\x00"), text.cast("binary")))


def unpack(c: ColumnOrName) -> Column:
    """The text of a packed column."""
    b = _col(c)
    rest = F.expr("2147483647")
    body = F.substring(b, F.lit(2), rest)
    return F.when(F.substring(b, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(body))).otherwise(body.cast("string"))


def place_of(c: ColumnOrName) -> Column:
    """What stands before the first delimiter of a key's text, given the key's first part:
    equal key texts have equal places, also where a part holds the delimiter."""
    return F.substring_index(normalise_key(c), KEY_DELIMITER, 1)


def _escape(c: Column) -> Column:
    s = c.cast("string")
    s = F.replace(s, F.lit("\\"), F.lit("\\\\"))
    return F.replace(s, F.lit(KEY_DELIMITER), F.lit("\\" + KEY_DELIMITER))


def hash_diff(*cols: ColumnOrName, algo: str = DEFAULT_ALGO, strict: bool = False) -> Column:
    """NULL-safe hash of payload columns in the given order.

    ``strict=False`` is the literal recipe: NULL and '' hash alike and an
    unescaped delimiter inside a value can collide.  ``strict=True`` escapes
    the delimiter and tags NULL so neither happens (decision D5).
    """
    return digest(diff_text(*cols, strict=strict), algo)


def diff_text(*cols: ColumnOrName, strict: bool = False) -> Column:
    """The text that ``hash_diff`` digests."""
    if not cols:
        raise ValueError("hash_diff needs at least one column")
    if strict:
        parts = [F.coalesce(_escape(_col(c)), F.lit("\\N")) for c in cols]
    else:
        parts = [F.coalesce(_col(c).cast("string"), F.lit(NULL_REPLACEMENT)) for c in cols]
    return _join(parts)


def brief(text: Column, algo: str = DEFAULT_ALGO) -> Column:
    """Bytes that are equal where the digests of texts are: a short text itself, which
    costs no digest, of a longer one the digest."""
    return F.when(F.octet_length(text) <= 32, F.concat(F.lit(b"\x00"), text.cast("binary"))).otherwise(F.concat(F.lit(b"\x01"), F.unhex(digest(text, algo))))


def digest_of_brief(b: Column, algo: str = DEFAULT_ALGO) -> Column:
    """The digest of the text of which ``b`` is the ``brief`` form."""
    body = F.substring(b, F.lit(2), F.expr("2147483647"))
    return F.when(F.substring(b, 1, 1) == F.lit(b"\x01"), F.lower(F.hex(body))).otherwise(digest(body, algo))


def key_is_valid(*cols: ColumnOrName) -> Column:
    """True when every key part is non-NULL and not blank (decision D3)."""
    cond = F.lit(True)
    for c in cols:
        n = normalise_key(c)
        cond = cond & n.isNotNull() & (n != F.lit(""))
    return cond
