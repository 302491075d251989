"""Documents cut into prefix, middle and suffix for fill-in-the-middle training.

A unit is a run of letters A-Z, a-z or one other character. To find the place after k units
without going through them, a text is cut into chunks by its content: a rolling hash of the last
32 bytes ends a chunk wherever its top bits are zero, so equal passages have equal chunks in
whichever text they stand. A worker keeps what it knows of a chunk (units, characters, whether it
begins or ends in a letter) under the chunk's own bytes, so that equal hashes alone never pass
for equal content. Chunks combine by adding their units, less one wherever a run of letters goes
on across their border; sums of these locate the chunk of a cut, and only that chunk is read.

Nulls: text counts as empty, a missing id as empty text. Repeated rows give repeated results.
Empty texts, those that hold a sentinel already and the share that `plain` leaves stay as they
are, with form `plain`. An empty table gives no rows. A text of any length is cut whole in its
own task. Columns of the input keep their values; `n`, `form`, `output`, `prefix_chars` and
`middle_chars` are this operator's own and replace such columns.
"""

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, functions as F

# ---- fixed values of the transformation ----------------------------------------------------
PREFIX, SUFFIX, MIDDLE = "<P>", "<S>", "<M>"
PLAIN_FROM, SPM_BELOW = 90, 20
# ---------------------------------------------------------------------------------------------
SHAPE = "n long, form string, output string, prefix_chars long, middle_chars long"

# A chunk ends on average after 2 ** CHUNK_BITS bytes, not before the least and not beyond the
# most, except to complete a character.
CHUNK_BITS, LEAST_CHUNK, MOST_CHUNK = 10, 256, 8_192
# A worker forgets its chunks once they hold so many bytes.
KNOWN_BYTES = 32 << 20

# One odd 32-bit number for each byte, spread by multiplication.
GEAR = (np.arange(1, 257, dtype=np.uint64) * 0x9E3779B97F4A7C15 >> 32).astype(np.uint32) | 1


def rolling(data: np.ndarray) -> np.ndarray:
    """At every byte, the sum of GEAR of the last 32 bytes, each shifted by how long ago it came."""
    hashes = GEAR[data]
    for step in (1, 2, 4, 8, 16):
        shifted = hashes[:-step] << np.uint32(step)
        hashes[step:] += shifted
    return hashes


def chunk_ends(data: np.ndarray) -> list[int]:
    """Where the chunks of a text end, the last at its end. None ends within a character."""
    size = len(data)
    if size <= LEAST_CHUNK:
        return [size] if size else []
    ends_here = np.flatnonzero(rolling(data) >> np.uint32(32 - CHUNK_BITS) == 0) + 1
    ends_here = ends_here[ends_here < size]
    ends_here = ends_here[(data[ends_here] & 0xC0) != 0x80]
    ends, at, begin = [], 0, 0
    places = ends_here.tolist()
    while begin < size:
        while at < len(places) and places[at] < begin + LEAST_CHUNK:
            at += 1
        end = min(begin + MOST_CHUNK, size)
        if at < len(places) and places[at] <= end:
            end = places[at]
        while end < size and data[end] & 0xC0 == 0x80:
            end += 1
        ends.append(end)
        begin = end
    return ends


def unit_starts(data: np.ndarray) -> np.ndarray:
    """Which bytes begin a unit, the first letter counted as if nothing went before it."""
    letter = ((data | 0x20) - np.uint8(ord("a"))) < 26
    starts = (data & 0xC0) != 0x80
    starts[1:] &= ~(letter[1:] & letter[:-1])
    return starts


class Chunks:
    """What a worker knows of the chunks it has met: (units, characters, first, last is a letter)."""

    def __init__(self):
        self.known: dict[bytes, tuple[int, int, bool, bool]] = {}
        self.held = 0

    def summary(self, chunk: bytes) -> tuple[int, int, bool, bool]:
        found = self.known.get(chunk)
        if found is None:
            data = np.frombuffer(chunk, np.uint8)
            units = int(np.count_nonzero(unit_starts(data)))
            chars = int(np.count_nonzero((data & 0xC0) != 0x80))
            found = units, chars, chunk[:1].isalpha(), chunk[-1:].isalpha()
            if self.held > KNOWN_BYTES:
                self.known.clear()
                self.held = 0
            self.known[chunk] = found
            self.held += len(chunk)
        return found

    def layout(self, raw: bytes) -> "Layout":
        data = np.frombuffer(raw, np.uint8)
        ends = chunk_ends(data)
        begins = [0, *ends[:-1]]
        units, chars, joined = [0], [0], []
        before = False
        for begin, end in zip(begins, ends):
            n_units, n_chars, first, last = self.summary(raw[begin:end])
            joined.append(before and first)
            units.append(units[-1] + n_units - joined[-1])
            chars.append(chars[-1] + n_chars)
            before = last
        return Layout(raw, begins, ends, units, chars, joined)


class Layout:
    """A text as chunks, with the units that begin and the characters that stand before each."""

    def __init__(self, raw, begins, ends, units, chars, joined):
        self.raw, self.begins, self.ends = raw, begins, ends
        self.units, self.chars, self.joined = units, chars, joined
        self.n = units[-1]

    def after(self, k: int) -> tuple[int, int]:
        """(byte, character) at which k units have ended."""
        if k == self.n:
            return len(self.raw), self.chars[-1]
        chunk = int(np.searchsorted(self.units, k, "right")) - 1
        data = np.frombuffer(self.raw, np.uint8)[self.begins[chunk] : self.ends[chunk]]
        starts = unit_starts(data)
        starts[0] &= not self.joined[chunk]
        place = int(np.flatnonzero(starts)[k - self.units[chunk]])
        chars = int(np.count_nonzero((data[:place] & 0xC0) != 0x80))
        return self.begins[chunk] + place, self.chars[chunk] + chars


def cut(text: str, digest: str, chunks: Chunks) -> tuple:
    """(n, form, output, prefix_chars, middle_chars) of one text, by its id's hex digest."""
    h1, h2, h3, h4 = (int(digest[at : at + 8], 16) for at in (0, 8, 16, 24))
    layout = chunks.layout(raw := text.encode())
    if not raw or h3 % 100 >= PLAIN_FROM or any(s in text for s in (PREFIX, SUFFIX, MIDDLE)):
        return layout.n, "plain", text, None, None
    (first, first_char), (last, last_char) = (
        layout.after(k) for k in sorted((h1 % (layout.n + 1), h2 % (layout.n + 1)))
    )
    prefix, middle, suffix = raw[:first].decode(), raw[first:last].decode(), raw[last:].decode()
    if h4 % 100 < SPM_BELOW:
        form, output = "spm", f"{SUFFIX}{suffix}{PREFIX}{prefix}{MIDDLE}{middle}"
    else:
        form, output = "psm", f"{PREFIX}{prefix}{SUFFIX}{suffix}{MIDDLE}{middle}"
    return layout.n, form, output, first_char, last_char - first_char


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", seed: str = "1:") -> DataFrame:
    """The documents with their form, output text, units and lengths. The key decides the cut:
    the same key and text give the same output in every run."""
    chunks = Chunks()

    def apply(texts: pa.Array, digests: pa.Array) -> pa.Array:
        rows = [
            cut(value or "", digest, chunks)
            for value, digest in zip(texts.to_pylist(), digests.to_pylist())
        ]
        columns = list(zip(*rows)) or [()] * 5
        kinds = (pa.int64(), pa.string(), pa.string(), pa.int64(), pa.int64())
        return pa.StructArray.from_arrays(
            [pa.array(column, kind) for column, kind in zip(columns, kinds)],
            ["n", "form", "output", "prefix_chars", "middle_chars"],
        )

    named = F.coalesce(F.col(key).cast("string"), F.lit(""))
    digest = F.sha2(F.concat(F.lit(seed), named), 256)
    made = F.arrow_udf(apply, SHAPE)(F.col(text).cast("string"), digest)
    own = [name.split()[0] for name in SHAPE.split(", ")]
    kept = [c for c in docs.columns if c.lower() not in own]
    return docs.select(*[F.col(f"`{c}`") for c in kept], made.alias("_made")).select(
        *[F.col(f"`{c}`") for c in kept], "_made.*"
    )


def restore(output: Column, form: Column) -> Column:
    """The text that an output was made from. No part holds a sentinel, so the three sentinels
    are where the output splits."""
    parts = F.split(output, "<[PSM]>", -1)
    order = F.when(form == "psm", F.array(F.lit(1), F.lit(3), F.lit(2))).when(
        form == "spm", F.array(F.lit(2), F.lit(3), F.lit(1))
    )
    joined = F.concat(*[F.get(parts, F.get(order, F.lit(n))) for n in range(3)])
    return F.when(form == "plain", output).otherwise(joined)
