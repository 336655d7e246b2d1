"""eBKP-H classification codes as column expressions.

A code is a capital letter, a number and up to two dot-separated sub-numbers
(``C02.01.03``). Normalising removes U+0020 blanks and leading zeros; the match is
anchored at the start only, so trailing text is dropped (``C2.1abc`` -> ``C2.1``).
Text that does not start like a code is returned with its blanks removed.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# The code pattern (letter, number, up to two sub-numbers) and the
# catalogue line pattern ("B 6.1 Abholzung, Rodung": letter, blanks, number with at most
# one sub-number, blanks, description).
CODE_PATTERN = r"^([A-Z])([0-9]+)(?:\.([0-9]+))?(?:\.([0-9]+))?"
CATALOGUE_LINE_PATTERN = r"^([A-Z])\s+([0-9]+(?:\.[0-9]+)?)\s+(.*)$"


def _as_col(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _strip_zeros(part: Column) -> Column:
    stripped = F.regexp_replace(part, r"^0+", "")
    return F.when(part == "", F.lit("")).when(stripped == "", F.lit("0")).otherwise(stripped)


def normalize_code(code, levels: int = 3) -> Column:
    """H1 (levels=3) / H2 (levels=2): canonical form of an eBKP-H code."""
    raw = F.replace(_as_col(code), F.lit(" "), F.lit(""))
    letter = F.regexp_extract(raw, CODE_PATTERN, 1)
    main = _strip_zeros(F.regexp_extract(raw, CODE_PATTERN, 2))
    sub1 = _strip_zeros(F.regexp_extract(raw, CODE_PATTERN, 3))
    sub2 = _strip_zeros(F.regexp_extract(raw, CODE_PATTERN, 4))
    code_text = F.concat(letter, main)
    if levels >= 2:
        code_text = F.concat(code_text, F.when(sub1 != "", F.concat(F.lit("."), sub1)).otherwise(F.lit("")))
    if levels >= 3:
        # the pattern nests the levels: a third part exists only after a second one
        code_text = F.concat(code_text, F.when(sub2 != "", F.concat(F.lit("."), sub2)).otherwise(F.lit("")))
    return F.when(raw.rlike(r"^[A-Z][0-9]+"), code_text).otherwise(raw)


def is_code(code) -> Column:
    """True when the (blank-stripped) text starts like an eBKP-H code."""
    return F.replace(_as_col(code), F.lit(" "), F.lit("")).rlike(r"^[A-Z][0-9]+")


def parent_code(normalized) -> Column:
    """H3: the code without its last ``.part``; null when the code has no dot."""
    c = _as_col(normalized)
    return F.when(F.instr(c, ".") > 0, F.regexp_replace(c, r"\.[^.]*$", ""))


def main_code(normalized) -> Column:
    """H3: letter plus first number (``C2.1.3`` -> ``C2``); null for non-codes."""
    c = _as_col(normalized)
    m = F.regexp_extract(c, r"^([A-Z][0-9]+)", 1)
    return F.when(m != "", m)
