"""Token counts of fields and lines by offsets.

A document is its fields joined by line ends, encoded once as a whole; every token has a span of
characters. Sections, the fields or their lines, tile the document, and tokens join them by interval. A
token that crosses a boundary is given by an explicit rule to the section that holds its first
character, its last, or most of it (the first of several).
"""

from __future__ import annotations

import os
import re
from functools import cache
from pathlib import Path

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from flowlake.llm.tasks import pieces, small_batches

#: Pieces kept between batches by one Python worker.
KNOWN = 500_000
RULES = ("first", "last", "most")
SPACE = r" \t\n\r\f\v"
CUT = re.compile(rf"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")
#: White space that the cut does not know; texts with it are encoded in one go.
OTHER_SPACE = re.compile("[\x1c-\x1f\x85\xa0  -     　]")
LONGEST = 1 << 15
COUNTS = "id {}, field string, section int, start long, n_chars long, n_tokens long, n_crossing long"


class SpanEncoder:
    """Token spans of whole texts for a byte-level tokenizer without a prefix space.

    Such a tokenizer always starts anew where white space follows other characters, so a text is cut
    there, and a distinct piece is encoded once while it is remembered.
    """

    def __init__(self, text: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        self.encoder, self.known = Tokenizer.from_str(text), {}

    def spans(self, texts: list[str]):
        """(starts, ends) of the tokens of each text."""
        cut = [None if OTHER_SPACE.search(t) else CUT.findall(t) for t in texts]
        cut = [None if c and max(map(len, c)) > LONGEST else c for c in cut]
        self._learn(set().union(*(c for c in cut if c)).difference(self.known))
        out = []
        for text, parts in zip(texts, cut):
            if parts is None:
                found = np.array(self.encoder.encode(text, add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
            else:
                packed = list(map(self.known.__getitem__, parts))
                counts = np.fromiter(map(len, packed), np.int64, len(packed)) // 4
                sizes = np.fromiter(map(len, parts), np.int64, len(parts))
                found = np.frombuffer(b"".join(packed), "<u2").reshape(-1, 2).astype(np.int64)
                found += np.repeat(np.cumsum(sizes) - sizes, counts)[:, None]
            out.append((found[:, 0], found[:, 1]))
        if len(self.known) > KNOWN:
            self.known.clear()
        return out

    def _learn(self, parts: set[str]) -> None:
        inner = [p for p in parts if p[0] in " \t\n\r\f\v" and p[-1] not in " \t\n\r\f\v"]
        for at in range(0, len(inner), 500):  # each starts with white space after another's end
            some = inner[at : at + 500]
            found = np.array(self.encoder.encode("".join(some), add_special_tokens=False).offsets, np.int64).reshape(-1, 2)
            sizes = np.array([len(p) for p in some])
            ends = np.cumsum(sizes)
            cuts = np.searchsorted(found[:, 0], ends)
            shift = np.repeat(ends - sizes, np.diff(cuts, prepend=0))
            flat, low = (found - shift[:, None]).astype("<u2").tobytes(), 0
            for part, high in zip(some, (cuts * 4).tolist()):
                self.known[part] = flat[low:high]
                low = high
        for part in parts.difference(inner):
            found = self.encoder.encode(part, add_special_tokens=False).offsets
            self.known[part] = np.array(found, "<u2").tobytes()


@cache
def span_encoder(text: str) -> SpanEncoder:
    return SpanEncoder(text)


def sections_of(values: list[str], lines: bool):
    """(field, section, start) of each section of fields that are joined by line ends."""
    fields, numbers, starts, at = [], [], [], 0
    for field, value in enumerate(values):
        own = [at]
        if lines:
            own += [at + m.end() for m in re.finditer("\n", value)]
        fields += [field] * len(own)
        numbers += range(len(own))
        starts += own
        at += len(value) + 1
    return fields, numbers, starts, max(at - 1, 0)


def attribute(starts: np.ndarray, ends: np.ndarray, sections: np.ndarray, total: int, rule: str):
    """(tokens, crossing tokens) of every section; sections are given by their starts."""
    first = np.searchsorted(sections, starts, "right") - 1
    last = np.maximum(np.searchsorted(sections, np.maximum(ends - 1, starts), "right") - 1, first)
    owner = last if rule == "last" else first.copy()
    crossing = np.flatnonzero(first != last)
    if rule == "most":
        bounds = np.append(sections, total)
        for k in crossing:
            inside = np.arange(first[k], last[k] + 1)
            held = np.minimum(bounds[inside + 1], ends[k]) - np.maximum(bounds[inside], starts[k])
            owner[k] = inside[int(np.argmax(held))]
    count = len(sections)
    return np.bincount(owner, minlength=count), np.bincount(owner[crossing], minlength=count)


def token_counts(docs: DataFrame, tokenizer: str, fields: list[str], rule: str = "first", lines: bool = True, id_col: str = "doc_id") -> DataFrame:
    """One row per section: id_col, field, section, start, n_chars, n_tokens, n_crossing.

    The document is the texts of ``fields`` joined by one line end each; the line end belongs to the
    section before. With ``lines`` every line of a field, its line end included, is a section, else
    the field is. section counts from 0 in a field; start and n_chars are in characters of the document;
    n_crossing are those of n_tokens that reach into other sections. The tokens of all sections are those
    of the document. Null fields are empty: one section, with at most the joining line end. Repeated rows
    are counted each, a null id is kept, other columns are ignored.
    """
    if rule not in RULES:
        raise ValueError(f"rule is one of {RULES}")
    vocabulary = Path(tokenizer).read_text()
    small_batches(docs.sparkSession)
    texts = [F.coalesce(F.col(c).cast("string"), F.lit("")) for c in fields]
    slim = docs.select(F.col(id_col).alias("id"), *(t.alias(f"f{k}") for k, t in enumerate(texts)))

    def count(batches):
        encoder = span_encoder(vocabulary)
        for piece in pieces(batches, f"f{len(fields) - 1}", 1 << 19):
            columns = [piece.column(k + 1).to_pylist() for k in range(len(fields))]
            rows = list(zip(*columns))
            at, out = [], [[] for _ in range(6)]
            for k, (values, (starts, ends)) in enumerate(zip(rows, encoder.spans(["\n".join(v) for v in rows]))):
                owner, numbers, begins, total = sections_of(values, lines)
                begins = np.array(begins, np.int64)
                tokens, crossing = attribute(starts, ends, begins, total, rule)
                sizes = np.diff(np.append(begins, total))
                at += [k] * len(owner)
                for column, found in zip(out, ([fields[f] for f in owner], numbers, begins.tolist(), sizes.tolist(), tokens.tolist(), crossing.tolist())):
                    column += found
            kinds = (pa.string(), pa.int32(), *[pa.int64()] * 4)
            yield pa.RecordBatch.from_arrays(
                [piece.column(0).take(pa.array(at, pa.int64())), *(pa.array(c, t) for c, t in zip(out, kinds))],
                ["id", "field", "section", "start", "n_chars", "n_tokens", "n_crossing"],
            )

    kind = COUNTS.format(slim.schema["id"].dataType.simpleString())
    return slim.mapInArrow(count, kind).withColumnRenamed("id", id_col)
