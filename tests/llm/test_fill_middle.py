"""Fill-in-middle over frames against a plain version, with frames of a few bytes, and on awkward tables."""

import hashlib
import re
from collections import Counter

import pytest
import zstandard
from pyspark.sql import functions as F

from strokelab.llm import fill_middle

DOCS = "doc_id long, text string, lang string, source string, n_chars long"
TEXTS = [
    None,
    "",
    "one line",
    "\n",
    "\n\n\n",
    "a\nb\nc\n",
    "a\nb\nc",
    "é🙂\nñ日本\n\r\n\x0b x\nend",
    "has <P> in it\nx",
    "has <S\n> not\n<M",
    "x<M>\ny",
    "<\nS>\n<\nP>\n<",
    "long unit " * 5000 + "\nshort\n" + "tail" * 3000,
    "\n".join(f"line {i} ü" * (i % 7) for i in range(3000)),
]


def plain(key, text):
    t = text or ""
    units = re.findall(r"[^\n]*\n|[^\n]+", t)
    h = hashlib.sha256(f"7:{'' if key is None else key}".encode()).hexdigest()
    h1, h2, h3, h4 = (int(h[i : i + 8], 16) for i in (0, 8, 16, 24))
    n = len(units)
    i, j = sorted((h1 % (n + 1), h2 % (n + 1)))
    if not t or any(m in t for m in ("<P>", "<S>", "<M>")) or h3 % 100 >= 100:
        return n, "plain", None, None, t, t
    p, m, s = "".join(units[:i]), "".join(units[i:j]), "".join(units[j:])
    if h4 % 100 < 50:
        return n, "spm", len(p), len(m), f"<S>{s}<P>{p}<M>{m}", t
    return n, "psm", len(p), len(m), f"<P>{p}<S>{s}<M>{m}", t


def rows():
    out = [(100 * k + i, t, "en", "a", 0) for k in range(6) for i, t in enumerate(TEXTS)]
    return [*out, (None, "no\nkey\n", None, None, None), out[-2], out[-2]]


@pytest.mark.parametrize("frame_bytes", [1, 7, 1 << 16])
def test_transform(spark, frame_bytes):
    few = rows() if frame_bytes > 1 else [r for r in rows() if len(r[1] or "") < 1000]
    docs = spark.createDataFrame(few, DOCS).withColumns({c: F.lit(1) for c in ("n", "form", "frames", "_text", "first", "output")})
    out = fill_middle.rearranged(fill_middle.with_cuts(fill_middle.store(docs, frame_bytes=frame_bytes)), frame_bytes)
    want = [(r[0], *plain(r[0], r[1])) for r in few]
    texts = fill_middle.plain_text(out).collect()
    assert Counter(map(tuple, texts)) == Counter(w[:6] for w in want)
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    assert Counter(map(tuple, fill_middle.digests(out).collect())) == Counter((*w[:5], sha(w[5]), sha(w[6])) for w in want)


def test_digest(spark):
    docs = spark.createDataFrame(rows(), DOCS)
    got = fill_middle.digest(docs)
    assert got.columns == ["doc_id", "n", "form", "prefix_chars", "middle_chars", "output_sha256", "restored_sha256"]
    sha = lambda x: hashlib.sha256(x.encode()).hexdigest()
    want = Counter((r[0], *w[:4], sha(w[4]), sha(w[5])) for r in rows() for w in [plain(r[0], r[1])])
    assert Counter(map(tuple, got.collect())) == want
    assert fill_middle.digest(docs.limit(0)).count() == 0
    assert {r["form"] for r in fill_middle.digest(docs, transformed_percent=0).collect()} == {"plain"}


def test_cuts_open_one_frame():
    text = "".join(f"{'w' * (i % 40)}\n" for i in range(20_000)).encode()
    pack, opened = zstandard.ZstdCompressor().compress, []
    parts = [text[a : a + 1000] for a in range(0, len(text), 1000)]
    units = [0]
    for p in parts[:-1]:
        units.append(units[-1] + p.count(b"\n"))

    def unpack(data):
        opened.append(data)
        return zstandard.ZstdDecompressor().decompress(data)

    for k in (0, 1, 777, 10_000, 19_999, 20_000):
        opened.clear()
        i, at = fill_middle.Frames(units, units, [pack(p) for p in parts], unpack).cut(k, 20_000)
        assert len(opened) <= 1 and (b"".join(parts[:i]) + (parts[i][:at] if i < len(parts) else b"")).count(b"\n") == k


def test_restoring_reads_the_output_alone(spark):
    docs = spark.createDataFrame([(i, f"a{i}\nb\nc\nd\n", "", "", 0) for i in range(40)], DOCS)
    out = fill_middle.rearranged(fill_middle.with_cuts(fill_middle.store(docs)))
    other = out.withColumn("form", F.when(F.col("form") == "psm", "plain").otherwise(F.col("form")))
    right, wrong = ({r["_key"]: r["restored_sha256"] for r in fill_middle.digests(x).collect()} for x in (out, other))
    changed = {r["_key"] for r in out.where("form = 'psm'").collect()}
    assert changed and {k for k in right if right[k] != wrong[k]} == changed
