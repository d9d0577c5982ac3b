"""Fill-in-middle transformation over seekable compressed frames.

A text is stored as independent zstandard frames of a fixed number of bytes.  Each frame knows how many units (lines) and
code points lie before it, so a cut behind unit k is found by bisection and only the frame that holds it is opened.  The
rearranged text is again a list of frames: frames that no cut touches are taken over as they are.  Digests, and the text
rebuilt from output and form, stream the frames in order, one at a time.

Defined results: a null text is an empty one; an empty text has no units and stays plain; a null key is hashed as an empty
string; equal rows give equal results, row by row; a text of any length costs one open frame of memory; further columns are
left out; an empty table gives an empty result.
"""

from __future__ import annotations

import hashlib
from bisect import bisect_left
from collections.abc import Iterable, Iterator

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from strokelab.llm.common import materialize

MARKS = {"prefix": b"<P>", "suffix": b"<S>", "middle": b"<M>"}
#: Order of the parts in the output of each form.
ORDER = {"psm": ("prefix", "suffix", "middle"), "spm": ("suffix", "prefix", "middle")}
FRAMES = "array<struct<units_before: long, chars_before: long, data: binary>>"
_FRAME = pa.struct([("units_before", pa.int64()), ("chars_before", pa.int64()), ("data", pa.binary())])
_CONTINUED = bytes(range(0x80, 0xC0))


def n_chars(data: bytes) -> int:
    """Code points that begin in these UTF-8 bytes; additive over any cut."""
    return len(data) if data.isascii() else len(data.translate(None, _CONTINUED))


def n_units(text: bytes) -> int:
    """Lines ``[^\\n]*\\n|[^\\n]+`` of a text."""
    return text.count(b"\n") + (not text.endswith(b"\n") and text != b"")


class Frames:
    """The frames of one text; the one opened last stays open."""

    def __init__(self, units: list[int], chars: list[int], data: list[bytes], unpack):
        self.units, self.chars, self.data, self.unpack, self.kept = units, chars, data, unpack, (-1, b"")

    def __len__(self) -> int:
        return len(self.data)

    def open(self, i: int) -> bytes:
        if self.kept[0] != i:
            self.kept = (i, self.unpack(self.data[i]))
        return self.kept[1]

    def cut(self, k: int, n: int) -> tuple[int, int]:
        """(frame, byte in it) behind unit k of n."""
        if k == 0:
            return 0, 0
        if k == n:
            return len(self), 0
        i = bisect_left(self.units, k) - 1
        opened, at = self.open(i), -1
        for _ in range(k - self.units[i]):
            at = opened.index(b"\n", at + 1)
        return i, at + 1

    def chars_to(self, cut: tuple[int, int], total: int) -> int:
        return self.chars[cut[0]] + n_chars(self.open(cut[0])[: cut[1]]) if cut[0] < len(self) else total


class Writer:
    """Frames of an output: loose bytes are gathered, whole frames taken over."""

    def __init__(self, pack, size: int):
        self.pack, self.size, self.loose, self.frames, self.chars, self.units = pack, size, bytearray(), [], 0, 0

    def flush(self) -> None:
        if self.loose:
            part = bytes(self.loose)
            self._add(self.pack(part), n_chars(part), part.count(b"\n"))
            self.loose.clear()

    def _add(self, data: bytes, chars: int, units: int) -> None:
        self.frames.append((self.units, self.chars, data))
        self.units, self.chars = self.units + units, self.chars + chars

    def add(self, part: bytes) -> None:
        self.loose += part
        if len(self.loose) >= self.size:
            self.flush()

    def take(self, data: bytes, chars: int, units: int) -> None:
        self.flush()
        self._add(data, chars, units)


def _lists(rows: list[list[tuple[int, int, bytes]]]) -> pa.Array:
    """One array of frames a row."""
    offsets, flat = [0], [f for r in rows for f in r]
    for r in rows:
        offsets.append(offsets[-1] + len(r))
    fields = [pa.array([f[i] for f in flat], t.type) for i, t in enumerate(_FRAME)]
    return pa.ListArray.from_arrays(pa.array(offsets, pa.int32()), pa.StructArray.from_arrays(fields, fields=list(_FRAME)))


def _frames(column: pa.Array, unpack) -> Iterator[Frames]:
    values, at = column.flatten(), 0
    units, chars, data = (values.field(n).to_pylist() for n in ("units_before", "chars_before", "data"))
    for size in column.value_lengths().to_pylist():
        yield Frames(units[at : at + size], chars[at : at + size], data[at : at + size], unpack)
        at += size


def store(docs: DataFrame, key: str = "doc_id", text: str = "text", frame_bytes: int = 1 << 16, level: int = 3) -> DataFrame:
    """Per row: key, n (units), chars, marked (the text holds one of the marks), frames."""
    names = ["_key", "n", "chars", "marked", "frames"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack = zstandard.ZstdCompressor(level=level).compress
        for b in batches:
            counts, marked, rows = ([], []), [], []
            for t in b.column(1):
                whole, out, units, chars = t.as_py() or b"", [], 0, 0
                for at in range(0, len(whole), frame_bytes):
                    part = whole[at : at + frame_bytes]
                    out.append((units, chars, pack(part)))
                    units, chars = units + part.count(b"\n"), chars + n_chars(part)
                for c, v in zip(counts, (n_units(whole), chars), strict=True):
                    c.append(v)
                marked.append(any(m in whole for m in MARKS.values()))
                rows.append(out)
            yield pa.RecordBatch.from_arrays([b.column(0), *[pa.array(c, pa.int64()) for c in counts], pa.array(marked, pa.bool_()), _lists(rows)], names)

    kind = dict(docs.dtypes)[key]
    return docs.select(F.col(key).alias("_key"), F.col(text).cast("binary").alias("_text")).mapInArrow(run, f"_key {kind}, n long, chars long, marked boolean, frames {FRAMES}")


def with_cuts(stored: DataFrame, salt: str = "7", transformed_percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """Adds form, first and last (units before the two cuts), chosen by the hash of the key."""
    digest = F.sha2(F.concat(F.lit(f"{salt}:"), F.coalesce(F.col("_key").cast("string"), F.lit(""))), 256)

    def h(i: int) -> Column:
        return F.conv(F.substring(digest, 8 * i - 7, 8), 16, 10).cast("long")

    a, b = h(1) % (F.col("n") + 1), h(2) % (F.col("n") + 1)
    plain = (F.col("n") == 0) | F.col("marked") | (h(3) % 100 >= transformed_percent)
    return stored.select(
        "*",
        F.when(plain, "plain").when(h(4) % 100 < spm_percent, "spm").otherwise("psm").alias("form"),
        F.least(a, b).alias("first"),
        F.greatest(a, b).alias("last"),
    )


def rearranged(cut: DataFrame, frame_bytes: int = 1 << 16, level: int = 3) -> DataFrame:
    """Per row: key, n, form, prefix_chars and middle_chars (null if plain), output (frames of the transformed text)."""
    names = ["_key", "n", "form", "prefix_chars", "middle_chars", "output"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        pack, unpack = zstandard.ZstdCompressor(level=level).compress, zstandard.ZstdDecompressor().decompress
        for b in batches:
            plan = zip(*[b.column(c).to_pylist() for c in ("n", "chars", "form", "first", "last")], strict=True)
            sizes, rows = ([], []), []
            for (n, chars, form, first, last), frames in zip(plan, _frames(b.column("frames"), unpack), strict=True):
                if form == "plain":
                    for c in sizes:
                        c.append(None)
                    rows.append(list(zip(frames.units, frames.chars, frames.data, strict=True)))
                    continue
                one, two = frames.cut(first, n), frames.cut(last, n)
                before = frames.chars_to(one, chars)
                sizes[0].append(before)
                sizes[1].append(frames.chars_to(two, chars) - before)
                ends = {"prefix": ((0, 0), one), "middle": (one, two), "suffix": (two, (len(frames), 0))}
                out = Writer(pack, frame_bytes)
                for part in ORDER[form]:
                    out.add(MARKS[part])
                    (i, x), (j, y) = ends[part]
                    for f in range(i, min(j + 1, len(frames))):
                        lo, hi = x if f == i else 0, y if f == j else None
                        if lo == 0 and hi is None and len(frames) > 1 and f + 1 < len(frames):
                            out.take(frames.data[f], frames.chars[f + 1] - frames.chars[f], frames.units[f + 1] - frames.units[f])
                        elif hi != 0:
                            out.add(frames.open(f)[lo:hi])
                out.flush()
                rows.append(out.frames)
            yield pa.RecordBatch.from_arrays([b.column("_key"), b.column("n"), b.column("form"), *[pa.array(c, pa.int64()) for c in sizes], _lists(rows)], names)

    kind = dict(cut.dtypes)["_key"]
    return cut.select("_key", "n", "chars", "form", "first", "last", "frames").mapInArrow(run, f"_key {kind}, n long, form string, prefix_chars long, middle_chars long, output {FRAMES}")


def parts_of(frames: Frames, form: str, digest) -> list[tuple[int, int]]:
    """Byte ranges of prefix, middle and suffix in an output; ``digest`` is fed with all of its bytes on the way."""
    wanted, found, starts, at, tail = [MARKS[p] for p in ORDER.get(form, ())], [], [], 0, b""
    for i in range(len(frames)):
        part = frames.open(i)
        digest.update(part)
        starts.append(at)
        seen, look = tail + part, 0
        while len(found) < len(wanted) and (look := seen.find(wanted[len(found)], look)) >= 0:
            found.append(at - len(tail) + look)
            look += 3
        tail, at = seen[-2:], at + len(part)
    frames.starts = [*starts, at]
    if not wanted:
        return [(0, at)]
    ranges = dict(zip(ORDER[form], zip([f + 3 for f in found], [*found[1:], at], strict=True), strict=True))
    return [ranges[p] for p in ("prefix", "middle", "suffix")]


def digests(output: DataFrame) -> DataFrame:
    """output_sha256, and restored_sha256 of the text rebuilt from output and form; both by streaming the frames."""
    names = ["_key", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            hashes = ([], [])
            for form, frames in zip(b.column("form").to_pylist(), _frames(b.column("output"), unpack), strict=True):
                written, restored = hashlib.sha256(), hashlib.sha256()
                for lo, hi in parts_of(frames, form, written):
                    for i in range(len(frames)):
                        begin, end = max(lo, frames.starts[i]), min(hi, frames.starts[i + 1])
                        if begin < end:
                            restored.update(memoryview(frames.open(i))[begin - frames.starts[i] : end - frames.starts[i]])
                hashes[0].append(written.hexdigest())
                hashes[1].append(restored.hexdigest())
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in names[:5]], *[pa.array(h, pa.string()) for h in hashes]], names)

    kind = dict(output.dtypes)["_key"]
    return output.select(*names[:5], "output").mapInArrow(run, f"_key {kind}, n long, form string, prefix_chars long, middle_chars long, output_sha256 string, restored_sha256 string")


def transform(docs: DataFrame, key: str = "doc_id", text: str = "text", salt: str = "7", transformed_percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """Per row: key, n, form, prefix_chars, middle_chars, output (the transformed text as frames; ``plain_text`` opens it)."""
    stored = materialize(store(docs, key, text), "frames")
    return rearranged(with_cuts(stored, salt, transformed_percent, spm_percent)).withColumnRenamed("_key", key)


def plain_text(output: DataFrame) -> DataFrame:
    """The rows of ``transform`` with ``output`` as a string, for texts that fit one."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        unpack = zstandard.ZstdDecompressor().decompress
        for b in batches:
            texts = [b"".join(f.open(i) for i in range(len(f))).decode() for f in _frames(b.column("output"), unpack)]
            yield pa.RecordBatch.from_arrays([*[b.column(c) for c in b.schema.names[:-1]], pa.array(texts, pa.string())], b.schema.names)

    head = [c for c in output.columns if c != "output"]
    schema = ", ".join(f"`{c}` {dict(output.dtypes)[c]}" for c in head)
    return output.select(*head, "output").mapInArrow(run, f"{schema}, output string")


def digest(docs: DataFrame, key: str = "doc_id", text: str = "text", salt: str = "7", transformed_percent: int = 100, spm_percent: int = 50) -> DataFrame:
    """Per row: key, n, form, prefix_chars, middle_chars, output_sha256, restored_sha256."""
    out = transform(docs, key, text, salt, transformed_percent, spm_percent)
    return digests(out.withColumnRenamed(key, "_key")).withColumnRenamed("_key", key)
