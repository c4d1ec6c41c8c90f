"""Fill-in-the-middle by displacement scatter.

A text of n code points is cut at two places into prefix, middle and suffix, which are written in
another order with a marker in front of each. ``fill_in_middle`` does this for whole Arrow batches of
texts as one byte buffer: one scan finds the byte place of every cut, a difference array holds, at the
first byte of each part, by how much the part's shift differs from the part before, its cumulative sum is
the shift of every byte, and one numpy scatter puts all bytes in their new place. ``restore_middle`` works
from the output and the form alone: the markers' places give the same difference array again, and a
gather reads the text back.

A slice holds at most ``SLICE`` bytes of texts, or one longer text; its scan, cumulative sums, scatter and
gather pass over it in windows of ``WINDOW`` bytes, so beside the input and the output memory does not grow with a text.

The cuts of a document come from the sha256 of ``<salt>:<doc_id>`` (see ``cut_hashes``), so they do not
depend on partitions or attempts. Texts that hold a marker are left plain: no other text can, so a marker in
an output of another form is never part of the text.

Defined cases: a null text is an empty one, and empty texts are plain; a null doc_id is hashed as empty
text; repeated rows give repeated rows; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

MARKERS = ("<P>", "<S>", "<M>")   # of prefix, suffix and middle
PLAIN, PSM, SPM = 0, 1, 2
FORMS = ("plain", "psm", "spm")
SLICE, WINDOW = 4 << 20, 1 << 20
OUT = "doc_id long, n long, form string, prefix_chars long, middle_chars long, output string"


def cut_hashes(doc_id: Column, salt: str) -> list[Column]:
    """Four numbers of 32 bits: the first groups of eight hex digits of sha256('<salt>:<doc_id>')."""
    digest = F.sha2(F.concat(F.lit(salt + ":"), F.coalesce(doc_id.cast("string"), F.lit(""))), 256)
    return [F.conv(F.substring(digest, 1 + 8 * i, 8), 16, 10).cast("long").alias(f"h{i + 1}") for i in range(4)]


def _buffer(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of the texts, and where each begins (with the end); null texts are empty."""
    texts = texts.fill_null("").cast(pa.large_binary())
    offsets = np.frombuffer(texts.buffers()[1], "<i8", count=len(texts) + 1, offset=8 * texts.offset)
    data = texts.buffers()[2]
    held = np.frombuffer(data, np.uint8) if data else np.zeros(0, np.uint8)
    return held[offsets[0]:offsets[-1]], offsets - offsets[0]


def _strings(data: np.ndarray, offsets: np.ndarray) -> pa.Array:
    return pa.LargeStringArray.from_buffers(len(offsets) - 1, pa.py_buffer(offsets.astype("<i8")), pa.py_buffer(data)).cast(pa.string())


def _starts(window: np.ndarray) -> np.ndarray:
    """Whether each byte begins a code point."""
    return (window & 0xC0) != 0x80


def count_points(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """Code points of each text."""
    before, seen = np.zeros(offsets.size, np.int64), 0
    for a in range(0, data.size, WINDOW):
        points = np.cumsum(_starts(data[a:a + WINDOW]), dtype=np.int32)
        inside = np.flatnonzero((offsets > a) & (offsets <= a + points.size))
        before[inside] = seen + points[offsets[inside] - a - 1]
        seen += int(points[-1])
    return np.diff(before)


def byte_places(data: np.ndarray, offsets: np.ndarray, points: np.ndarray, cuts: np.ndarray) -> np.ndarray:
    """The byte place in ``data`` of code point ``cuts[i]`` of text i; its end where the text has as many."""
    wanted = np.concatenate([[0], np.cumsum(points)])[:-1] + cuts   # code points before the cut, over all texts
    place, seen = offsets[1:].copy(), 0
    open_, order = cuts < points, np.argsort(wanted, kind="stable")
    order = order[open_[order]]
    sorted_wanted = wanted[order]
    for a in range(0, data.size, WINDOW):
        firsts = np.flatnonzero(_starts(data[a:a + WINDOW]))
        lo, hi = np.searchsorted(sorted_wanted, [seen, seen + firsts.size])
        place[order[lo:hi]] = a + firsts[sorted_wanted[lo:hi] - seen]
        seen += firsts.size
    return place


def _moved(source: np.ndarray, target: np.ndarray, starts: np.ndarray, shifts: np.ndarray, back: bool = False) -> None:
    """Scatter ``source[i]`` to ``target[i + shift]``, or with ``back`` gather it from there.

    ``starts`` (ascending) are the first bytes of the parts of the text side, ``shifts`` their displacements.
    """
    size = target.size if back else source.size
    step, carry = np.diff(shifts, prepend=0), 0
    for a in range(0, size, WINDOW):
        z = min(size, a + WINDOW)
        lo, hi = np.searchsorted(starts, [a, z])
        change = np.zeros(z - a, np.int64)
        np.add.at(change, starts[lo:hi] - a, step[lo:hi])   # empty parts share a place
        if change.size:
            change[0] += carry
        place = np.cumsum(change)
        carry = int(place[-1]) if place.size else carry
        place += np.arange(a, z)
        if back:
            target[a:z] = source[place]
        else:
            target[place] = source[a:z]


def _parts(form: np.ndarray, first: np.ndarray, last: np.ndarray, begin: np.ndarray, end: np.ndarray, to: np.ndarray):
    """Starts of prefix, middle and suffix of each text and their shifts when its output begins at ``to``."""
    n, mark = len(MARKERS[0]), form != PLAIN
    prefix, middle, suffix = first - begin, last - first, end - last
    spm = form == SPM
    at_prefix = to + np.where(spm, 2 * n + suffix, n * mark)
    at_suffix = to + np.where(spm, n, np.where(mark, 2 * n + prefix, prefix + middle))
    at_middle = to + np.where(mark, 3 * n + prefix + suffix, prefix)
    starts = np.stack([begin, first, last], 1).ravel()
    shifts = np.stack([at_prefix - begin, at_middle - first, at_suffix - last], 1).ravel()
    return starts, shifts, at_prefix, at_middle, at_suffix


def scatter(texts: pa.Array, form: np.ndarray, cut: np.ndarray, cut2: np.ndarray) -> pa.Array:
    """The outputs of texts whose prefix and middle end after ``cut`` and ``cut2`` code points."""
    data, offsets = _buffer(texts)
    points = count_points(data, offsets)
    begin, end = offsets[:-1], offsets[1:]
    first, last = byte_places(data, offsets, points, cut), byte_places(data, offsets, points, cut2)
    n, mark = len(MARKERS[0]), form != PLAIN
    to = np.concatenate([[0], np.cumsum(end - begin + 3 * n * mark)])
    starts, shifts, at_prefix, at_middle, at_suffix = _parts(form, first, last, begin, end, to[:-1])
    out = np.empty(int(to[-1]), np.uint8)
    _moved(data, out, starts, shifts)
    for marker, place in zip(MARKERS, (at_prefix, at_suffix, at_middle)):
        for k, byte in enumerate(marker.encode()):
            out[place[mark] - n + k] = byte
    return _strings(out, to)


def _marker_places(data: np.ndarray, marker: bytes) -> np.ndarray:
    found = []
    for a in range(0, data.size, WINDOW):
        w = data[a:a + WINDOW + len(marker) - 1]
        m = w.size - len(marker) + 1
        if m > 0:
            hit = np.ones(m, bool)
            for k, byte in enumerate(marker):
                hit &= w[k:k + m] == byte
            found.append(a + np.flatnonzero(hit))
    return np.concatenate(found) if found else np.zeros(0, np.int64)


def gather(outputs: pa.Array, form: np.ndarray) -> pa.Array:
    """The texts again, from outputs and forms alone."""
    data, offsets = _buffer(outputs)
    n, mark = len(MARKERS[0]), form != PLAIN
    to, size = offsets[:-1], np.diff(offsets) - 3 * n * mark
    place = []
    for marker in MARKERS:
        all_, at = _marker_places(data, marker.encode()), to.copy()
        at[mark] = all_[np.searchsorted(all_, to[mark])]   # plain outputs may hold any number of them
        place.append(at)
    p, s, m = place
    spm = form == SPM
    prefix = np.where(spm, m - p - n, np.where(mark, s - p - n, size))
    suffix = np.where(spm, p - s - n, np.where(mark, m - s - n, 0))
    texts = np.concatenate([[0], np.cumsum(size)])
    begin, end = texts[:-1], texts[1:]
    starts, shifts, *_ = _parts(form, begin + prefix, end - suffix, begin, end, to)
    out = np.empty(int(texts[-1]), np.uint8)
    _moved(data, out, starts, shifts, back=True)
    return _strings(out, texts)


def _slices(batch: pa.RecordBatch, column: int):
    """Slices of at most SLICE bytes in ``column``, or of one row."""
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    ends, a = np.cumsum(sizes, dtype=np.int64), 0
    while a < batch.num_rows:
        before = int(ends[a - 1]) if a else 0
        z = max(a + 1, int(np.searchsorted(ends, before + SLICE, "right")))
        yield batch.slice(a, z - a)
        a = z


def fill_in_middle(docs: DataFrame, salt: str = "1", plain_percent: int = 10, spm_percent: int = 20) -> DataFrame:
    """(doc_id, n, form, prefix_chars, middle_chars, output) of every document.

    With the hashes h1..h4 of its id, the prefix ends after the smaller and the middle after the larger of
    h1 and h2 modulo n + 1; ``plain_percent`` of the texts (by h3) stay as they are and ``spm_percent``
    of the others (by h4) take the form suffix, prefix, middle. Lengths are null for plain texts.
    """

    def work(batches):
        for whole in batches:
            for b in _slices(whole, 1):
                texts = b.column(1)
                h = [b.column(2 + i).to_numpy() for i in range(4)]
                marked = pc.or_(pc.or_(*[pc.match_substring(texts, x) for x in MARKERS[:2]]), pc.match_substring(texts, MARKERS[2]))
                data, offsets = _buffer(texts)
                n = count_points(data, offsets)
                plain = (n == 0) | marked.fill_null(True).to_numpy(zero_copy_only=False) | (h[2] % 100 >= 100 - plain_percent)
                form = np.where(plain, PLAIN, np.where(h[3] % 100 < spm_percent, SPM, PSM))
                one, two = h[0] % (n + 1), h[1] % (n + 1)
                cut, cut2 = np.minimum(one, two), np.maximum(one, two)
                lengths = [pa.array(x, pa.int64(), mask=plain) for x in (cut, cut2 - cut)]
                yield pa.RecordBatch.from_arrays([b.column(0), pa.array(n, pa.int64()), pa.array([FORMS[f] for f in form], pa.string()), *lengths,
                                                  scatter(texts, form, cut, cut2)], names=["doc_id", "n", "form", "prefix_chars", "middle_chars", "output"])

    rows = docs.select(F.col("doc_id").cast("long"), F.coalesce(F.col("text").cast("string"), F.lit("")).alias("text"), *cut_hashes(F.col("doc_id").cast("long"), salt))
    return rows.mapInArrow(work, OUT)


def restore_middle(filled: DataFrame) -> DataFrame:
    """``fill_in_middle``'s rows with ``restored``, the text read back from ``output`` and ``form``."""
    fields = [f.strip() for f in OUT.split(",")]

    def work(batches):
        for whole in batches:
            for b in _slices(whole, 5):
                form = np.array([FORMS.index(f) for f in b.column(2).to_pylist()], dtype=np.int64)
                yield pa.RecordBatch.from_arrays([*b.columns, gather(b.column(5), form)], names=[*[f.split()[0] for f in fields], "restored"])

    return filled.select(*[f.split()[0] for f in fields]).mapInArrow(work, OUT + ", restored string")
