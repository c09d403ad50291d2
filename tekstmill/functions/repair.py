"""Repair of broken encodings, entities, quotes and control characters."""

from __future__ import annotations

import re
import unicodedata

import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

from .references import REFERENCE, decode_references
from .settle import settle

CURLY_QUOTES = "‘’‚‛“”„‟"
STRAIGHT_QUOTES = "''''" + '""""'
# C0 and C1 controls but tab, newline and carriage return, and the byte order mark.
# Terminal colour codes go first, while their escape byte is still there.
CONTROL = r"[\x00-\x08\x0B\x0C\x0E-\x1F\x7F-\x9F\x{FEFF}]"
TERMINAL_ESCAPE = r"\x1B\[[0-9;]*[A-Za-z]"
COMBINING = r"\p{M}"
# A text without any of these is left as it is by all repairs after those of references and encodings.
ODD_SIGN = rf"[{CONTROL[1:-1]}{CURLY_QUOTES}{COMBINING}]"


# Signs of the Western single-byte encoding beyond Latin-1, and the byte of each.
WESTERN = {bytes([b]).decode("cp1252", errors="ignore"): b for b in range(0x80, 0xA0)}
WESTERN.pop("", None)
FOLLOWING = "[\u0080-\u00bf" + "".join(sorted(WESTERN)) + "]"
MISREAD = f"[\u00c2-\u00df]{FOLLOWING}|[\u00e0-\u00ef]{FOLLOWING}{{2}}|[\u00f0-\u00f4]{FOLLOWING}{{3}}"
MISREAD_PATTERN = re.compile(MISREAD)
# How every misread run begins, without alternatives.
MISREAD_START = f"[\u00c2-\u00f4]{FOLLOWING}"
# Signs that may well stand after a letter: quotes, dashes, the ellipsis, no-break spaces, inverted marks.
AFTER_LETTERS = frozenset("‘’‚“”„‹›«»–—…•\u00a0¡¿´·\u00ad")
# Of those, the ones after which even a capital Â or Ã is plausible: quotes, guillemets, dashes, the ellipsis.
QUOTES_AND_DASHES = frozenset("‘’‚“”„‹›«»–—…")


def _decoded(run: str) -> str | None:
    """The character whose UTF-8 bytes were read one by one, NULL where there is none."""
    try:
        return bytes(WESTERN.get(c) or ord(c) for c in run).decode("utf-8")
    except (UnicodeDecodeError, ValueError):
        return None


def _is_certain(run: str) -> bool:
    """Whether no clean text has such a run: it opens with a letter that stands alone in few languages, or holds a
    sign that doesn't follow letters. An Å before a quote is not certain, nor a capital Â or Ã before a quote, a
    guillemet, a dash or an ellipsis (“AMANHÃ”, MAÇÃ…, IRMÃ—, LÂ»)."""
    if run[0] in "ÂÃ":
        return not QUOTES_AND_DASHES.issuperset(run[1:])
    return run.startswith("â€") or not AFTER_LETTERS.issuperset(run[1:])


def fix_misread(text: str) -> str:
    """Decode runs of UTF-8 that were misread as a Western encoding.

    Uncertain runs are decoded only in a text that has certain ones and no letter beyond ASCII outside of runs.
    """
    runs = {r: d for r in set(MISREAD_PATTERN.findall(text)) if (d := _decoded(r)) is not None}
    certain = {r for r in runs if _is_certain(r)}
    if not certain:
        return text
    rest = MISREAD_PATTERN.sub(lambda m: "" if m[0] in runs else m[0], text)
    trusted = runs if not any(c.isalpha() and not c.isascii() for c in rest) else certain
    return MISREAD_PATTERN.sub(lambda m: runs[m[0]] if m[0] in trusted else m[0], text)


def fix_mojibake(text: Column) -> Column:
    """Only texts that hold a run go through the Arrow function; for all others it receives NULL."""

    @F.arrow_udf("string")
    def fix(batch: pa.Array) -> pa.Array:
        return pa.array([None if t is None else fix_misread(t) for t in batch.to_pylist()], pa.string())

    return F.coalesce(fix(F.when(text.rlike(MISREAD_START) & text.rlike(MISREAD), text)), text)


def drop_controls(text: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(text, TERMINAL_ESCAPE, ""), CONTROL, "")


def normal_form(text: Column, form: str = "NFC") -> Column:
    """Unicode normal form. Spark SQL has no such function, so texts with combining
    marks go through an Arrow batch function; for all others it receives NULL."""

    @F.arrow_udf("string")
    def normalise(batch: pa.Array) -> pa.Array:
        done = [None if t is None else unicodedata.normalize(form, t) for t in batch.to_pylist()]
        return pa.array(done, pa.string())

    return F.coalesce(normalise(F.when(text.rlike(COMBINING), text)), text)


def repair_text(
    docs: DataFrame,
    text_col: str = "text",
    mojibake: bool = True,
    entities: bool = True,
    quotes: bool = True,
    controls: bool = True,
    unicode_form: str | None = "NFC",
) -> DataFrame:
    """All repairs in order; every row is kept. Entities are left alone where the text
    looks like markup. Each repair is a projection of its own, because it names its
    input several times."""
    text = F.col(text_col)
    if entities:
        plain = text.contains("&") & text.rlike(REFERENCE.pattern) & ~text.contains("<")
        docs = settle(docs, text_col, F.coalesce(decode_references(F.when(plain, text)), text))
    if mojibake:
        docs = settle(docs, text_col, fix_mojibake(text))
    if controls or quotes:
        mended = drop_controls(text) if controls else text
        mended = F.translate(mended, CURLY_QUOTES, STRAIGHT_QUOTES) if quotes else mended
        # One search of the text instead of one for each repair.
        docs = settle(docs, text_col, F.when(text.rlike(ODD_SIGN), mended).otherwise(text))
    if unicode_form:
        docs = settle(docs, text_col, normal_form(text, unicode_form))
    return docs
