"""Plain Python versions of the contracts, to hold the queries against."""

from __future__ import annotations

import base64
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = {i: i + 32 for i in range(65, 91)}


def base_counts(text):
    text = text or ""
    w = WORD.findall(text)
    lines = [x for x in text.split("\n") if WORD.search(x)]
    grams = Counter(zip(w, w[1:], w[2:], strict=False))
    hit = set()
    for i in range(len(w) - 2):
        if grams[w[i], w[i + 1], w[i + 2]] > 1:
            hit |= {i, i + 1, i + 2}
    return len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text)), len(lines) - len(set(lines)), len(hit)


def fingerprint(text, words=3):
    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i : i + words]) for i in range(len(w) - words + 1)] if len(w) >= words else [" ".join(w)] if w else []
    ones = [0] * 64
    for g in grams:
        h = xxhash.xxh64_intdigest(g.encode(), seed=42)
        for b in range(64):
            ones[b] += h >> b & 1
    return sum(1 << b for b in range(64) if 2 * ones[b] > len(grams))


def jaccard(a, b):
    """Share of five-word shingles that two texts have in common."""
    def grams(text):
        w = WORD.findall((text or "").translate(LOWER))
        return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} or {tuple(w)}

    x, y = grams(a), grams(b)
    return len(x & y) / len(x | y)


def slots(text):
    """The min-wise fingerprint of a text's five-word shingles."""
    import numpy as np

    from tidewatch.llm import minwise

    w = WORD.findall((text or "").translate(LOWER))
    grams = [" ".join(w[i : i + 5]) for i in range(len(w) - 4)] if len(w) >= 5 else [" ".join(w)] if w else []
    return np.frombuffer(minwise.fingerprint(np.array([xxhash.xxh64_intdigest(g.encode(), seed=42) for g in grams], np.uint64)), np.uint8)


def reach(prints, like=lambda a, b: (a ^ b).bit_count() <= 3):
    """Smallest reachable id of {id: fingerprint}."""
    ids = sorted(prints)
    up = {i: i for i in ids}

    def root(i):
        while up[i] != i:
            i = up[i]
        return i

    for k, i in enumerate(ids):
        for j in ids[k + 1 :]:
            if like(prints[i], prints[j]):
                a, b = sorted((root(i), root(j)))
                up[b] = a
    return {i: root(i) for i in ids}


def contamination(docs, items):
    pattern = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    windows = defaultdict(set)
    for item, text in items:
        w = pattern.findall((text or "").translate(LOWER))
        m = min(10, len(w))
        for i in range(len(w) - m + 1 if m else 0):
            windows[tuple(w[i : i + m])].add(str(item))
    sizes = sorted({len(x) for x in windows})
    out = []
    for doc, text in docs:
        w = pattern.findall((text or "").translate(LOWER))
        hit, found = set(), set()
        for m in sizes:
            for i in range(len(w) - m + 1):
                if tuple(w[i : i + m]) in windows:
                    hit |= set(range(i, i + m))
                    found |= windows[tuple(w[i : i + m])]
        out.append((doc, len(w), len(hit), len(found), hashlib.sha256(",".join(sorted(found)).encode()).hexdigest(), bool(hit)))
    return sorted(out)


def repeats(docs):
    words = [(doc, WORD.findall(text or "")) for doc, text in docs]
    least = {}
    for doc, w in words:
        for i in range(len(w) - 12):
            k = tuple(w[i : i + 13])
            least[k] = min(least.get(k, doc), doc)
    out = []
    for doc, w in words:
        hit = set()
        for i in range(len(w) - 12):
            if least[tuple(w[i : i + 13])] < doc:
                hit |= set(range(i, i + 13))
        left = " ".join(x for i, x in enumerate(w) if i not in hit)
        out.append((doc, len(w), len(hit), hashlib.sha256(left.encode()).hexdigest()))
    return sorted(out)


def archives(pages):
    largest = {}
    for page, html in pages:
        largest[html or ""] = max(largest.get(html or "", page), page)
    out = []
    for page, html in pages:
        data, first = (html or "").encode(), largest[html or ""]
        out.append((page, len(data), base64.b32encode(hashlib.sha1(data).digest()).decode(), "response" if first == page else "revisit", None if first == page else first))
    return sorted(out)


def chats(turns):
    by = defaultdict(list)
    for conv, turn, role, text in turns:
        by[conv].append((turn, role or "", text or ""))
    out = []
    for conv, rows in by.items():
        rows.sort()
        whole = "".join(f"{r}\n{t}\n" for _, r, t in rows)
        loss = "".join(t for _, r, t in rows if r == "assistant")
        out.append((conv, len(rows), hashlib.sha256(whole.encode()).hexdigest(), len(loss), hashlib.sha256(loss.encode()).hexdigest()))
    return sorted(out)


def tokens(docs, path, end):
    """(doc_id, start, n_tokens, crc) over whole texts in order of id."""
    from tokenizers import Tokenizer

    coder = Tokenizer.from_file(path)
    coder.encode_special_tokens = True
    out, start = [], 0
    for doc, text in sorted(docs, key=lambda x: x[0]):
        ids = [*coder.encode(text or "", add_special_tokens=False).ids, end]
        out.append((doc, start, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids)), ids))
        start += len(ids)
    return out
