"""Fill-in-middle: a text cut into prefix, middle and suffix and put in another order.

A text is a sequence of units (code points by default, any pattern may be given). One
``fullmatch`` of ``(unit)*`` by the regex library keeps every repetition of the group, so that
``ends(1)`` is the list of all units' ends: its length is the number of units and both cuts
are read from it. A text of more than ``PIECE`` code points is matched piece by piece (the
library keeps 16 bytes and more a repetition, and fails near ten million); a piece's last
repetition is matched again by the next piece, so a unit is never cut.

Where the cuts fall and which form a document gets are hashes of its id: the form is ``plain``
(text as it is), ``psm`` (prefix, suffix, middle) or ``spm`` (suffix, prefix, middle). A text
that holds a marker is always plain, so an output can be taken apart again.

Defined results: null text counts as empty; an empty text is plain; a text that is no sequence
of units is plain with null ``n``; a null id hashes as the empty id; repeated rows are returned
each; an empty table gives no rows; other columns are ignored."""

from __future__ import annotations

import hashlib

import pyarrow as pa
import regex
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import plain_columns, steps

#: Markers before the prefix, the suffix and the middle.
MARKERS = ("<P>", "<S>", "<M>")
#: A unit of a text, and most code points of one match.
CODE_POINT, PIECE = r"(?s:.)", 1_000_000

SCHEMA = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def cuts(text: str, units: regex.Pattern, first: int, second: int, piece: int = PIECE):
    """(number of units, end of the prefix, end of the middle) by two hashes; None if ``text`` is
    no sequence of units. ``units`` is the compiled ``(unit)*``."""
    if len(text) <= piece:
        whole = units.fullmatch(text)
        ends = whole.ends(1) if whole else None
    else:
        ends = _ends_by_piece(text, units, piece)
    if ends is None:
        return None
    n = len(ends)
    low, high = sorted((first % (n + 1), second % (n + 1)))
    return n, ends[low - 1] if low else 0, ends[high - 1] if high else 0


def _ends_by_piece(text: str, units: regex.Pattern, piece: int):
    ends, at, size = [], 0, piece
    while at < len(text):
        upto = min(len(text), at + size)
        found = units.match(text, at, upto).ends(1)
        if upto < len(text):
            found = found[:-1]  # the last one may have been cut short
        elif not found or found[-1] < upto:
            return None
        if found:
            ends += found
            at, size = found[-1], piece
        elif upto < len(text):
            size *= 2  # one unit fills the piece
    return ends


def seeds(doc_id: int | None, seed: int) -> list[int]:
    """The first four 32-bit numbers of the SHA-256 of ``seed:doc_id``."""
    digest = hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).digest()
    return [int.from_bytes(digest[i:i + 4], "big") for i in (0, 4, 8, 12)]


def transform(docs: DataFrame, unit: str = CODE_POINT, seed: int = 1, plain_from: int = 90, spm_below: int = 20,
              markers: tuple[str, str, str] = MARKERS, piece: int = PIECE) -> DataFrame:
    """``docs`` (doc_id, text) -> doc_id, n, form, prefix_chars, middle_chars, output. Of 100
    documents about ``100 - plain_from`` stay plain and ``spm_below`` of 100 others are ``spm``."""
    p, s, m = markers

    def run(batches):
        units = regex.compile(f"({unit})*")

        def one(doc_id, text):
            h1, h2, h3, h4 = seeds(doc_id, seed)
            found = cuts(text, units, h1, h2, piece)
            if not found or not text or any(x in text for x in markers) or h3 % 100 >= plain_from:
                return found[0] if found else None, "plain", None, None, text
            n, a, b = found
            if h4 % 100 < spm_below:
                return n, "spm", a, b - a, f"{s}{text[b:]}{p}{text[:a]}{m}{text[a:b]}"
            return n, "psm", a, b - a, f"{p}{text[:a]}{s}{text[b:]}{m}{text[a:b]}"

        kinds = [pa.int64(), pa.string(), pa.int64(), pa.int64(), pa.string()]
        for part in steps(batches):
            rows = [one(i, t or "") for i, t in zip(part.column(0).to_pylist(), part.column(1).to_pylist())]
            columns = [pa.array(x, k) for x, k in zip(zip(*rows), kinds)]
            yield pa.RecordBatch.from_arrays([part.column(0), *columns], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    return plain_columns(docs, "doc_id", "text").mapInArrow(run, SCHEMA)


def restored(output: Column, form: Column, markers: tuple[str, str, str] = MARKERS) -> Column:
    """The text that ``output`` was made from."""
    parts = F.split(output, "|".join(r"\Q" + x + r"\E" for x in markers), -1)
    return (F.when(form == "psm", F.concat(parts[1], parts[3], parts[2]))
            .when(form == "spm", F.concat(parts[2], parts[3], parts[1])).otherwise(output))
