"""Plain Python versions of the corpus operators, for small tables."""

import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
A_Z = {c: c + 32 for c in range(65, 91)}


def simhash(text):
    words = WORD.findall((text or "").translate(A_Z))
    if not words:
        return 0
    grams = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    hs = [xxhash.xxh64_intdigest(g.encode(), 42) for g in grams]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def components(docs, budget=2):
    fps = {d: simhash(t) for d, t in docs}
    parent = {d: d for d in fps}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    ids = sorted(fps)
    for i, a in enumerate(ids):
        for b in ids[i + 1 :]:
            if (fps[a] ^ fps[b]).bit_count() <= budget:
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    return {d: (f"{fps[d]:016x}", find(d)) for d in ids}


def quality(text):
    t = text or ""
    words = WORD.findall(t)
    windows = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    hit = set()
    for i in range(len(words) - 7):
        if windows[tuple(words[i : i + 8])] > 1:
            hit.update(range(i, i + 8))
    lines = [x for x in t.split("\n") if WORD.search(x)]
    n = len(words)
    return {
        "n_words": n,
        "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in t),
        "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(hit),
        "base_failed": n < 20 or 100 * len(hit) > 30 * n,
    }


def strip(docs, length=35):
    words = {d: WORD.findall(t or "") for d, t in docs}
    seen = Counter(tuple(w[i : i + length]) for w in words.values() for i in range(len(w) - length + 1))
    out = {}
    for d, w in words.items():
        gone = [False] * len(w)
        for i in range(len(w) - length + 1):
            if seen[tuple(w[i : i + length])] > 1:
                gone[i : i + length] = [True] * length
        kept = " ".join(x for x, g in zip(w, gone, strict=True) if not g)
        out[d] = (len(w), sum(gone), hashlib.sha256(kept.encode()).hexdigest())
    return out


def check_packing(docs, rows, encode, capacity=1024):
    """rows: dicts with doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset.  Returns padding and ids."""
    by_doc, by_seq = defaultdict(list), defaultdict(list)
    for r in rows:
        by_doc[r["doc_id"]].append(r)
        by_seq[r["sequence_id"]].append(r)
    total = 0
    for d, t in docs:
        ids = encode(t or "") + [0]
        total += len(ids)
        at = 0
        for r in sorted(by_doc[d], key=lambda r: r["start"]):
            assert r["start"] == at and r["length"] > 0 and r["doc_tokens"] == len(ids)
            part = ids[at : at + r["length"]]
            assert zlib.crc32(b"".join(x.to_bytes(4, "little") for x in part)) == r["ids_crc32"]
            at += r["length"]
        assert at == len(ids)
    padding = 0
    for rs in by_seq.values():
        at = 0
        for r in sorted(rs, key=lambda r: r["offset"]):
            assert r["offset"] == at
            at += r["length"]
        assert at <= capacity
        padding += 0 if at & (at - 1) == 0 else capacity - at
    return padding, total


def secrets_base(text):
    kinds = ("assign", "access", "hex")
    t = text or ""
    out = [("assign", m.start(), m.end()) for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A) if len(m[2]) >= 12]
    out += [("access", m.start(), m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 18]
    out += [("hex", m.start(), m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 16]
    return sorted(out, key=lambda s: (s[1], kinds.index(s[0])))


def license_base(text):
    words = re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", (text or "").translate(A_Z))
    at = []
    for phrase, label in (("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")):
        p = phrase.split()
        at += [(i, label) for i in range(len(words)) if words[i : i + len(p)] == p]
    places = [i for i, _ in at]
    return len(words), len(at), min(places, default=None), max(places, default=None), ",".join(sorted({label for _, label in at}))


def edits(passage, text):
    """Fewest edits of the passage against any part of the text."""
    row = [0] * (len(text) + 1)
    for i, c in enumerate(passage, 1):
        new = [i]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[j - 1] + 1))
        row = new
    return min(row)
