"""Text keys: area-name normalisation (H1), column-name normalisation (B11),
exact-value edits (H2) and code-keyed name overrides (H3).

Everything here returns a ``Column`` built from JVM expressions, so it stays
inside whole-stage code generation; no Python runs per row.
"""

from __future__ import annotations

import functools
import re
import unicodedata
from collections.abc import Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# FIXED VALUES (must equal the reference so that keys match its edit tables).
# Steps of the name key, applied in this order after lower-casing:
#   1. delete the word " and " (with its spaces)
#   2. delete each of these characters:  & / , . - ' ( ) ’
#   3. delete all whitespace (Unicode-aware, plus the separators \x1c-\x1f)
#   4. delete "agus"
#   5. delete a trailing "ward"
#   6. NFKD compatibility decomposition, then drop everything non-ASCII
# ---------------------------------------------------------------------------
NAME_DELETE_WORD = " and "
NAME_DELETE_CHARS = "&/,.-'()’"
NAME_DELETE_TOKEN = "agus"
NAME_TRAILING_TOKEN = "ward"

_DELETE_RE = r"(?U)[\s\x1c-\x1f" + "".join("\\" + c if c in "-\\[]^&" else c for c in NAME_DELETE_CHARS) + "]+"
_NON_ASCII_RE = r"[^\x00-\x7F]"


@functools.lru_cache(maxsize=1)
def _nfkd_ascii_tables() -> tuple[str, str, dict[str, str], str]:
    """Derive the NFKD→ASCII tables from ``unicodedata`` (built by rule, not listed).

    Returns ``(one_from, one_to, multi, multi_class)``: characters whose ASCII residue is a
    single character go to ``translate``; those with a longer residue go to a map (and
    ``multi_class`` is a regex class matching them); characters with no ASCII residue are
    left to the final non-ASCII deletion.
    """
    one_from, one_to, multi = [], [], {}
    for cp in range(0x80, 0x110000):
        if 0xD800 <= cp <= 0xDFFF:
            continue
        ch = chr(cp)
        decomposed = unicodedata.normalize("NFKD", ch)
        if decomposed == ch:
            continue
        residue = decomposed.encode("ascii", "ignore").decode("ascii")
        if not residue:
            continue
        if len(residue) == 1:
            one_from.append(ch)
            one_to.append(residue)
        else:
            multi[ch] = residue
    return "".join(one_from), "".join(one_to), multi, _range_class(sorted(multi))


def _range_class(chars: list[str]) -> str:
    """A regex class of the given characters with consecutive code points merged
    into ranges (a few dozen ranges instead of hundreds of single characters)."""
    runs: list[list[int]] = []
    for cp in sorted(ord(c) for c in chars):
        if runs and cp == runs[-1][1] + 1:
            runs[-1][1] = cp
        else:
            runs.append([cp, cp])
    part = "\\x{%x}"
    return "[" + "".join(part % a if a == b else part % a + "-" + part % b for a, b in runs) + "]"


_SEP = "\x01"  # never part of a key (all >= U+0080) nor of an NFKD residue


def _multi_map_column() -> Column:
    """The multi-character folds as one map literal, built JVM-side from two
    delimited strings (a handful of calls, not one per entry)."""
    _, _, multi, _ = _nfkd_ascii_tables()
    keys, values = zip(*sorted(multi.items()))
    assert not any(_SEP in k or _SEP in v for k, v in multi.items())
    return F.map_from_arrays(F.split(F.lit(_SEP.join(keys)), _SEP), F.split(F.lit(_SEP.join(values)), _SEP))


def ascii_fold(c: Column) -> Column:
    """NFKD-decompose and keep the ASCII part, per character.

    Per-character folding equals folding the whole string because NFKD only
    decomposes and reorders combining marks, which are non-ASCII and dropped.
    """
    one_from, one_to, multi, _ = _nfkd_ascii_tables()
    assert all(ord(ch) > 0x7F for ch in one_from + "".join(multi))
    single = F.translate(c, one_from, one_to)
    # The per-character map is needed only for ligatures, fractions and similar
    # forms; most rows never take this branch. The gate is a hash-based delete
    # of those characters (one linear pass); measured faster here than a regex
    # class, which inflates the generated code of the whole expression.
    has_multi = F.length(F.translate(single, "".join(sorted(multi)), "")) < F.length(single)
    expanded = F.when(
        has_multi,
        F.array_join(
            F.transform(
                F.split(single, ""),
                lambda ch: F.coalesce(F.try_element_at(_multi_map_column(), ch), ch),
            ),
            "",
        ),
    ).otherwise(single)
    folded = F.regexp_replace(expanded, _NON_ASCII_RE, "")
    # NFKD leaves ASCII unchanged, so pure-ASCII text (one byte per character, a
    # byte count against the O(1) byte length) skips the tables and the regex.
    return F.when(F.length(c) == F.octet_length(c), c).otherwise(folded)


def normalise_name(c: Column | str) -> Column:
    """H1: the matching key of an area name; null becomes ``''``."""
    c = F.col(c) if isinstance(c, str) else c
    s = F.lower(F.coalesce(c.cast("string"), F.lit("")))
    s = F.replace(s, F.lit(NAME_DELETE_WORD), F.lit(""))
    # Steps 2 and 3 both delete single characters, so deleting their union in one
    # pass gives the same text as deleting one set after the other.
    s = F.regexp_replace(s, _DELETE_RE, "")
    s = F.replace(s, F.lit(NAME_DELETE_TOKEN), F.lit(""))
    # a trailing token: an O(1) suffix test instead of a regex scanning the text
    n = len(NAME_TRAILING_TOKEN)
    s = F.when(s.endswith(NAME_TRAILING_TOKEN), F.left(s, F.length(s) - n)).otherwise(s)
    return ascii_fold(s)


# FIXED VALUES: the rule for column names, in this order, after lower-casing: a space between word characters becomes an
# underscore; parenthesised parts go; other spaces go.
COLUMN_NAME_RULE = ((r"(?<=\w) (?=\w)", "_"), (r"\(.*?\)", ""), (r" ", ""))


def normalise_column_name(name: str) -> str:
    """B11 on one name, by ``COLUMN_NAME_RULE``."""
    return functools.reduce(lambda text, step: re.sub(step[0], step[1], text), COLUMN_NAME_RULE, name.lower())


def map_literal(mapping: Mapping[str, str]) -> Column:
    """A ``MAP<STRING,STRING>`` literal (small, driver-side specs only)."""
    if not mapping:
        return F.create_map().cast("map<string,string>")
    if any(_SEP in str(k) or _SEP in str(v) for k, v in mapping.items()):
        return F.create_map(*[F.lit(x) for kv in mapping.items() for x in kv])
    keys, values = zip(*mapping.items())
    return F.map_from_arrays(F.split(F.lit(_SEP.join(keys)), _SEP), F.split(F.lit(_SEP.join(values)), _SEP))


def value_edits(c: Column | str, mapping: Mapping[str, str]) -> Column:
    """H2: replace values found in ``mapping``; others (and nulls) unchanged."""
    c = F.col(c) if isinstance(c, str) else c
    if not mapping:
        return c
    return F.coalesce(F.try_element_at(map_literal(mapping), c), c)


def disambiguate(code: Column | str, name: Column | str, mapping: Mapping[str, str]) -> Column:
    """H3: for codes in ``mapping`` the name is replaced by the mapped value."""
    code = F.col(code) if isinstance(code, str) else code
    name = F.col(name) if isinstance(name, str) else name
    if not mapping:
        return name
    return F.coalesce(F.try_element_at(map_literal(mapping), code), name)
