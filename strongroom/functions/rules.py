"""Soft-rule and scrub column builders.

Patterns are plain regular expressions that Java and RE2 read alike.
Fixed values:
  email         [A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\\.[A-Za-z]{2,}
  phone         a '+' and 8 or more digits and separators; or a leading 0 and
                groups of digits; or three groups with blanks or hyphens (no
                dates, plain numbers or addresses of four numbers)
  E.164 shape   \\+[1-9][0-9]{6,14}
  masks         <EMAIL>, <PHONE>
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMAIL_RE = r"[A-Za-z0-9._%+-]+@[A-Za-z0-9.-]+\.[A-Za-z]{2,}"
PHONE_RE = (
    r"\+[0-9][0-9 ()./-]{6,}[0-9]"
    r"|\b0[0-9]{1,4}[ -]?[0-9]{3,4}[ -]?[0-9]{2,5}\b"
    r"|\(?\b[0-9]{2,4}\)?[ -][0-9]{3,4}[ -][0-9]{3,4}\b"
)
E164_RE = r"^\+[1-9][0-9]{6,14}$"
EMAIL_MASK = "<EMAIL>"
PHONE_MASK = "<PHONE>"


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def email_is_valid(c) -> Column:
    return F.coalesce(_c(c).rlike("^" + EMAIL_RE + "$"), F.lit(False))


def phone_e164(c, default_country_code: str = "61") -> Column:
    """Digits only; a national number (leading 0) gets the default country
    code; NULL unless the result has the E.164 shape."""
    digits = F.regexp_replace(_c(c), r"[^0-9+]", "")
    national = F.regexp_replace(digits, r"^0", "")
    shaped = F.when(digits.startswith("+"), digits).otherwise(F.concat(F.lit("+" + default_country_code), national))
    return F.when(shaped.rlike(E164_RE), shaped)


def mask_emails(c) -> Column:
    return F.regexp_replace(_c(c), EMAIL_RE, EMAIL_MASK)


def mask_phones(c) -> Column:
    return F.regexp_replace(_c(c), PHONE_RE, PHONE_MASK)


def scrub_text(c) -> Column:
    return mask_phones(mask_emails(c))
