"""Plain versions of the corpus operators, for small tables in memory."""

from __future__ import annotations

import base64
import hashlib
import re
from collections import Counter, defaultdict

import numpy as np
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def sha(data: str | bytes) -> str:
    return hashlib.sha256(data.encode() if isinstance(data, str) else data).hexdigest()


def luhn(digits: str) -> bool:
    doubled = [sum(divmod(2 * int(d), 10)) if i % 2 else int(d) for i, d in enumerate(digits[::-1])]
    return sum(doubled) % 10 == 0


def pii(text):
    text = text or ""
    digits = lambda s: re.sub("[^0-9]", "", s)
    found = [("email", *m.span()) for m in re.finditer(r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", text)]
    found += [
        ("ip", *m.span()) for m in re.finditer(r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", text) if all(int(n) <= 255 for n in m[0].split("."))
    ]
    found += [
        ("card", *m.span()) for m in re.finditer(r"[0-9]([\x20-]?[0-9])+", text) if 13 <= len(digits(m[0])) <= 19 and luhn(digits(m[0]))
    ]
    return found + [("phone", *m.span()) for m in re.finditer(r"\+[0-9][\x20().0-9-]+[0-9]", text) if 9 <= len(digits(m[0])) <= 15]


_ANY_CASE = "".join(f"[{c.upper()}{c}]" if c.isalpha() else c for c in "password|passwd|secret|token|api_?key")
_ASSIGN = re.compile(rf"({_ANY_CASE})[\"']?\x20*[:=]\x20*[\"']?([A-Za-z0-9+/_.=-]+)")


def secrets(text):
    text = text or ""
    found = [("assign", *m.span()) for m in _ASSIGN.finditer(text) if len(m[2]) >= 12]
    found += [("access", *m.span()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 18]
    found += [("hex", *m.span()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 16]
    return sorted(found, key=lambda s: (s[1], ("assign", "access", "hex").index(s[0])))


def joined(spans):
    return ",".join(f"{k}:{s}:{e}" for k, s, e in spans)


def counts(text):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    windows = [tuple(words[i : i + 3]) for i in range(len(words) - 2)]
    inside = {i + k for i, w in enumerate(windows) if windows.count(w) > 1 for k in range(3)}
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(inside)


def runs(rows, width=50):
    """(doc_id, text) -> (doc_id, n_words, n_removed, kept)."""
    last = 2**63 - 1
    key = lambda d: last if d is None else d
    first = {}
    split = [(d, WORD.findall(t or "")) for d, t in rows]
    for d, words in split:
        for i in range(len(words) - width + 1):
            run = tuple(words[i : i + width])
            first[run] = min(first.get(run, last), key(d))
    out = []
    for d, words in split:
        gone = np.zeros(len(words), bool)
        for i in range(len(words) - width + 1):
            if first[tuple(words[i : i + width])] < key(d):
                gone[i : i + width] = True
        out.append((d, len(words), int(gone.sum()), " ".join(w for w, g in zip(words, gone) if not g)))
    return out


def strings(rows, width=100):
    """(doc_id, text) -> (doc_id, n_bytes, n_removed, n_spans, kept)."""
    last = 2**63 - 1
    raw = [(last if d is None else d, d, (t or "").encode()) for d, t in rows]
    first = {}
    for key, _, b in raw:
        for i in range(len(b) - width + 1):
            first[b[i : i + width]] = min(first.get(b[i : i + width], (last, last)), (key, i))
    out = []
    for key, d, b in raw:
        gone = np.zeros(len(b), bool)
        for i in range(len(b) - width + 1):
            if first[b[i : i + width]] < (key, i):
                gone[i : i + width] = True
        spans = int((np.diff(gone.astype(int), prepend=0) == 1).sum())
        out.append((d, len(b), int(gone.sum()), spans, np.frombuffer(b, np.uint8)[~gone].tobytes()))
    return out


def fingerprint(text):
    words = (text or "").encode().lower().split()
    shingles = [b" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))] if words else []
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def groups(prints, radius=2):
    """Fingerprints -> for each the smallest index reachable by links."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i, a in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j]).bit_count() <= radius:
                a_root, b_root = find(i), find(j)
                root[max(a_root, b_root)] = min(a_root, b_root)
    return [find(i) for i in range(len(prints))]


def mix(rows, weights=(5, 2, 1), most=3, seed="mix-1"):
    """(doc_id, text, source) -> per row size, source_size, target, copies."""
    sizes = [len(WORD.findall(t or "")) for _, t, _ in rows]
    total = {}
    for (_, _, s), n in zip(rows, sizes):
        total[s] = total.get(s, 0) + n
    order = sorted((s for s in total if s is not None), key=lambda s: s.encode()) + [s for s in total if s is None]
    weight = {s: weights[i % len(weights)] for i, s in enumerate(order)}
    full, target = set(), {}
    while True:
        left = sum(total.values()) - sum(most * total[s] for s in full)
        open_ = [s for s in order if s not in full]
        share = sum(weight[s] for s in open_)
        target = {s: float(most * total[s]) if s in full else left / share * weight[s] for s in order}
        over = {s for s in open_ if target[s] > most * total[s]}
        if not over:
            break
        full |= over
    out = []
    for (d, t, s), n in zip(rows, sizes):
        rate = target[s] / total[s] if total[s] else 0.0
        name = str(d) if d is not None else hashlib.md5((t or "").encode()).hexdigest()
        draw = int(hashlib.md5(f"{seed}:{name}".encode()).hexdigest()[:12], 16) / 16**12
        out.append((n, total[s], target[s], int(rate) + (draw < rate - int(rate))))
    return out


def tokenizer():
    import public_tokenizers
    import tiktoken

    with open(public_tokenizers.path("byte_bpe_50k.tiktoken"), "rb") as lines:
        ranks = {base64.b64decode(t): int(r) for t, r in map(bytes.split, lines)}
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens={})


def collocations(rows, least=30, top=2000):
    """(lang, text) -> (lang, rank, phrase, a, l, r, n, score)."""
    lower = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
    counts, sizes, out = defaultdict(Counter), Counter(), []
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", (text or "").translate(lower)):
            words = re.findall(r"[^\x20\x09]+", piece)
            sizes[lang] += len(words)
            counts[lang].update(tuple(words[i : i + k]) for k in range(1, 5) for i in range(len(words) - k + 1))
    for lang, known in counts.items():
        candidates = {p: a for p, a in known.items() if len(p) > 1 and a >= least}
        covered = {p[i : i + k] for p, a in candidates.items() for k in range(2, len(p)) for i in range(len(p) - k + 1) if 100 * a >= 80 * known[p[i : i + k]]}
        scored = []
        for p, a in candidates.items():
            if p not in covered:
                score, k = min((2000000 * a // (known[p[:k]] + known[p[k:]]), k) for k in range(1, len(p)))
                scored.append((-score, -a, " ".join(p).encode(), known[p[:k]], known[p[k:]]))
        out += [(lang, i, p.decode(), -a, l, r, sizes[lang], -s) for i, (s, a, p, l, r) in enumerate(sorted(scored)[:top], 1)]
    return out


def whitened(vectors, most=16):
    """Usable vectors -> per vector its deviation, and the eigenvalues, and the whitened matrix up to signs."""
    x = [[int(np.floor(64 * float(c))) + 1000000 for c in v] for v in vectors]
    fit = sorted(set(map(tuple, x)))
    n, sums = len(fit), [sum(column) for column in zip(*fit)]
    deviations = [sum((n * v - s) ** 2 for v, s in zip(row, sums)) for row in x]
    centred = np.array(fit, float) - np.array(sums, float) / n
    values, found = np.linalg.eigh(centred.T @ centred / n)
    values, found = values[::-1][:most], found[:, ::-1][:, :most]
    return n, deviations, values, values / np.trace(centred.T @ centred / n), (np.array(x, float) - np.array(sums, float) / n) @ found / np.sqrt(values)
