"""Plain readings of the contracts, for small tables."""

import hashlib
import re
from collections import defaultdict

import sentencepiece
import xxhash


def substrings(docs, n=50):
    """op3: {doc_id: (n_bytes, n_removed, n_spans, kept bytes)}."""
    first = {}
    for d, t in sorted(docs, key=lambda r: r[0]):
        b = (t or "").encode()
        for i in range(len(b) - n + 1):
            first.setdefault(b[i:i + n], d)
    out = {}
    for d, t in docs:
        b = (t or "").encode()
        gone = bytearray(len(b))
        for i in range(len(b) - n + 1):
            if first[b[i:i + n]] < d:
                gone[i:i + n] = b"\1" * n
        spans = len(re.findall(b"\1+", bytes(gone)))
        out[d] = (len(b), sum(gone), spans, bytes(x for x, g in zip(b, gone) if not g))
    return out


def fingerprint(text, k=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + k]) for i in range(max(1, len(words) - k + 1))]
    hs = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hs) > len(hs))


def simhash(docs, radius=4):
    """op7: {doc_id: (hex fingerprint, component)}."""
    prints = [(d, fingerprint(t)) for d, t in docs]
    by = defaultdict(list)
    for d, f in prints:
        by[f].append(d)
    fs, root = list(by), {f: f for f in by}

    def find(f):
        while root[f] != f:
            f = root[f]
        return f
    for i, a in enumerate(fs):
        for b in fs[:i]:
            if (a ^ b).bit_count() <= radius:
                root[find(a)] = find(b)
    least = {}
    for d, f in prints:
        least[find(f)] = min(least.get(find(f), d), d)
    return {d: (f"{f:016x}", least[find(f)]) for d, f in prints}


def pieces(docs, path):
    """op10: {doc_id: (n_tokens, ids_sha256, decoded_sha256)}."""
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    out = {}
    for d, t in docs:
        ids = sp.encode(t or "", add_eos=True)
        out[d] = (len(ids), hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest(),
                  hashlib.sha256(sp.decode(ids).encode()).hexdigest())
    return out


def lines(docs, n=3):
    """op2: {doc_id: text left}; docs in id order."""
    seen, out = set(), {}
    for d, t in sorted(docs, key=lambda r: r[0]):
        ls = (t or "").split("\n")
        at = [i for i, s in enumerate(ls) if s.strip(" \t\r\x0b\x0c")]
        gone, own = set(), []
        for k in range(len(at) - n + 1):
            w = tuple(ls[i].strip(" \t\r\x0b\x0c") for i in at[k:k + n])
            if w in seen:
                gone |= set(at[k:k + n])
            seen.add(w)
            own.append(w)
        for a, b in zip(at, at[1:]):
            if a in gone and b in gone:
                gone |= set(range(a, b))
        out[d] = "\n".join(s for i, s in enumerate(ls) if i not in gone)
    return out
