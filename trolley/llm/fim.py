"""Fill-in-middle: documents cut in three and put in another order, by a piece table.

A document is never copied while it is rearranged. It is a row of descriptors (buffer,
start, length) over two buffers that do not change: the texts of the Arrow batch, and the
sentinels. Cutting splits a descriptor, an arrangement permutes descriptors, and hashes and
texts are made by going through them. To restore a text its sentinels are searched in the
output; that gives descriptors over the output, which the inverse permutation sorts.

Forms: ``plain`` leaves the text as it is, ``psm`` writes prefix, suffix, middle, ``spm``
suffix, prefix, middle, each behind its sentinel. Whether and where a text is cut is drawn from
a hash of its id, so it does not depend on partitions or on the run.

Defined cases: a null text is an empty text; an empty text, and one that holds a sentinel, is
plain; a null id draws like an empty one; rows are handled each for itself, so repeated ids give
equal draws; other columns are not looked at; an empty table gives no rows. Cuts lie between code
points. A task holds one Arrow batch, and one output where texts are restored.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from trolley.llm.shared import text_of, text_slices

PLAIN, PSM, SPM = "plain", "psm", "spm"
#: Where prefix, middle and suffix go in the output.
ORDERS = {PSM: (0, 2, 1), SPM: (2, 0, 1)}
PREFIX, MIDDLE, SUFFIX = range(3)
#: Code points are searched in blocks of so many bytes.
BLOCK = 1 << 16


class Piece(NamedTuple):
    """A descriptor: ``length`` bytes from ``start`` on in a buffer, by number."""

    buffer: int
    start: int
    length: int

    def split(self, at: int) -> tuple[Piece, Piece]:
        return self._replace(length=at), Piece(self.buffer, self.start + at, self.length - at)


class Sentinels:
    """The marks in front of prefix, suffix and middle, as the second buffer."""

    def __init__(self, prefix: str = "<P>", suffix: str = "<S>", middle: str = "<M>"):
        marks = [mark.encode() for mark in (prefix, middle, suffix)]
        if not all(marks) or len({*marks}) < 3:
            raise ValueError("three different sentinels are needed")
        self.buffer = b"".join(marks)
        starts = np.cumsum([0, *map(len, marks)]).tolist()
        self.pieces = [Piece(1, start, len(mark)) for start, mark in zip(starts, marks)]
        self.numbers = {mark: number for number, mark in enumerate(marks)}
        # Longer ones first, in case one begins another.
        ordered = sorted(marks, key=len, reverse=True)
        self.pattern = re.compile(b"|".join(map(re.escape, ordered)))


# --- one document -----------------------------------------------------------------


def code_points(data: np.ndarray) -> int:
    """Code points of UTF-8 bytes: all bytes but those that go on with one."""
    return sum(
        int(np.count_nonzero((data[at : at + BLOCK] & 0xC0) != 0x80))
        for at in range(0, len(data), BLOCK)
    )


def byte_places(data: np.ndarray, n: int, places: Iterable[int]) -> list[int]:
    """Where the code points with these ascending numbers start; ``n`` is their number."""
    if n == len(data):
        return list(places)
    wanted, out, passed = list(places), [], 0
    for at in range(0, len(data), BLOCK):
        lead = (data[at : at + BLOCK] & 0xC0) != 0x80
        here = int(np.count_nonzero(lead))
        while len(out) < len(wanted) and wanted[len(out)] < passed + here:
            out.append(at + int(np.flatnonzero(lead)[wanted[len(out)] - passed]))
        passed += here
    return out + [len(data)] * (len(wanted) - len(out))


def cut(whole: Piece, first: int, second: int) -> list[Piece]:
    """Prefix, middle and suffix, from two places in bytes."""
    prefix, rest = whole.split(first)
    middle, suffix = rest.split(second - first)
    return [prefix, middle, suffix]


def arranged(parts: list[Piece], form: str, sentinels: Sentinels) -> list[Piece]:
    """The output: the parts in the order of the form, each behind its sentinel."""
    return [p for number in ORDERS[form] for p in (sentinels.pieces[number], parts[number])]


def stream(pieces: Iterable[Piece], buffers: tuple) -> Iterator[memoryview]:
    """The bytes behind descriptors, one after the other, without a copy."""
    for piece in pieces:
        yield buffers[piece.buffer][piece.start : piece.start + piece.length]


def digest(parts: Iterable[memoryview]) -> str:
    out = hashlib.sha256()
    for part in parts:
        out.update(part)
    return out.hexdigest()


def restored(output: bytes | memoryview, form: str, sentinels: Sentinels) -> list[Piece]:
    """Descriptors over ``output`` (buffer 0) that give the text back.

    The parts hold no sentinel, so each one found belongs to the arrangement.
    """
    if form == PLAIN:
        return [Piece(0, 0, len(output))]
    found = [(m.start(), m.end(), sentinels.numbers[m.group()]) for m in
             sentinels.pattern.finditer(output)]
    if tuple(number for _, _, number in found) != ORDERS[form]:
        raise ValueError(f"not an output of the form {form}")
    stops = [start for start, _, _ in found[1:]] + [len(output)]
    parts = {number: Piece(0, end, stop - end) for (_, end, number), stop in zip(found, stops)}
    return [parts[number] for number in (PREFIX, MIDDLE, SUFFIX)]


# --- Spark --------------------------------------------------------------------------


def draws(doc_id: Column, salt: str = "1:") -> Column:
    """Four unsigned numbers of 32 bits from the SHA-256 of ``salt`` and the id as text."""
    text = F.concat(F.lit(salt), F.coalesce(doc_id.cast("string"), F.lit("")))
    groups = [F.substring(F.sha2(text, 256), 8 * i + 1, 8) for i in range(4)]
    return F.array(*[F.conv(group, 16, 10).cast("bigint") for group in groups])


FIELDS = {
    "doc_id": pa.int64(),
    "n": pa.int64(),
    "form": pa.string(),
    "prefix_chars": pa.int64(),
    "middle_chars": pa.int64(),
    "output_sha256": pa.string(),
    "restored_sha256": pa.string(),
}
SCHEMA = (
    "doc_id bigint, n bigint, form string, prefix_chars bigint, middle_chars bigint, "
    "output_sha256 string, restored_sha256 string"
)


def transformed(
    docs: DataFrame,
    fim_percent: int = 90,
    spm_percent: int = 20,
    marks: tuple[str, str, str] = ("<P>", "<S>", "<M>"),
    drawn: Column | None = None,
    with_output: bool = False,
) -> DataFrame:
    """Every text cut and rearranged; (doc_id, n, form, prefix_chars, middle_chars,
    output_sha256, restored_sha256), and the ``output`` itself if asked for.

    ``n``, ``prefix_chars`` and ``middle_chars`` count code points; the latter are null where
    the form is plain. ``drawn`` holds four numbers: the first two, modulo n + 1, are the
    cuts, the third decides by its last two digits between plain and cut, the fourth between
    spm and psm. ``restored_sha256`` is that of the text rebuilt from output and form.
    No shuffle: each task goes through its own texts.
    """

    def transform(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentinels = Sentinels(*marks)
        for batch in batches:
            for part in text_slices(batch):
                rows = _rows(part, sentinels, fim_percent, spm_percent, with_output)
                columns = list(zip(*rows))
                fields = {**FIELDS, **({"output": pa.string()} if with_output else {})}
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, kind) for c, kind in zip(columns, fields.values())],
                    names=list(fields),
                )

    doc_id = F.col("doc_id").cast("bigint")
    rows = docs.select(
        doc_id.alias("doc_id"),
        text_of().alias("text"),
        (draws(doc_id) if drawn is None else drawn).alias("draws"),
    )
    return rows.mapInArrow(transform, SCHEMA + (", output string" if with_output else ""))


def _rows(
    part: pa.RecordBatch,
    sentinels: Sentinels,
    fim_percent: int,
    spm_percent: int,
    with_output: bool,
) -> Iterator[tuple]:
    """The results of one slice; its texts are the first buffer."""
    texts = part.column("text").cast(pa.large_string())
    _, places, content = texts.buffers()
    edges = np.frombuffer(places, np.int64)[texts.offset : texts.offset + len(texts) + 1]
    buffers = (memoryview(content or b""), memoryview(sentinels.buffer))
    numbers = part.column("draws").to_pylist()
    ids = part.column("doc_id").to_pylist()
    for doc_id, start, stop, (a, b, c, d) in zip(ids, edges.tolist(), edges[1:].tolist(), numbers):
        whole = Piece(0, start, stop - start)
        data = np.frombuffer(buffers[0], np.uint8, stop - start, start)
        n = code_points(data)
        form, prefix, middle = PLAIN, None, None
        pieces = [whole]
        if n and c % 100 < fim_percent and not sentinels.pattern.search(buffers[0], start, stop):
            form = SPM if d % 100 < spm_percent else PSM
            first, second = sorted((a % (n + 1), b % (n + 1)))
            parts = cut(whole, *byte_places(data, n, (first, second)))
            pieces = arranged(parts, form, sentinels)
            prefix, middle = first, second - first
        output = b"".join(stream(pieces, buffers))
        again = restored(output, form, sentinels)
        row = (
            doc_id,
            n,
            form,
            prefix,
            middle,
            digest(stream(pieces, buffers)),
            digest(stream(again, (memoryview(output),))),
        )
        yield (*row, output.decode()) if with_output else row


def restored_texts(outputs: DataFrame, marks: tuple[str, str, str] = ("<P>", "<S>", "<M>")):
    """(doc_id, text) from (doc_id, form, output): the inverse of ``transformed``.

    A row whose form is null or unknown, or whose output is not of its form, raises.
    """

    def restore(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sentinels = Sentinels(*marks)
        for batch in batches:
            for part in text_slices(batch, "output"):
                texts = []
                for form, output in zip(part.column("form").to_pylist(),
                                        part.column("output").to_pylist()):
                    if form not in (PLAIN, *ORDERS):
                        raise ValueError(f"unknown form {form}")
                    data = memoryview(output.encode())
                    texts.append(b"".join(stream(restored(data, form, sentinels), (data,))).decode())
                yield pa.RecordBatch.from_arrays(
                    [part.column("doc_id"), pa.array(texts, pa.string())], names=["doc_id", "text"]
                )

    rows = outputs.select(
        F.col("doc_id").cast("bigint").alias("doc_id"), "form", text_of("output").alias("output")
    )
    return rows.mapInArrow(restore, "doc_id bigint, text string")
