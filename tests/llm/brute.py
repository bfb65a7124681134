"""Plain versions of the operators, for small tables."""

import hashlib
import itertools
import re
import string

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANKS = str.maketrans(dict.fromkeys(string.punctuation + "\t\r\x0b\x0c", " "))
WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def cut_repeats(rows, length=50):
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), sorted."""
    first = {}
    data = [(-(1 << 63) if i is None else i, i, (t or "").encode()) for i, t in rows]
    for key, _, b in data:
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            first[w] = min(key, first.get(w, key))
    out = []
    for key, i, b in data:
        cover = bytearray(len(b))
        for p in range(len(b) - length + 1):
            if first[b[p : p + length]] < key:
                cover[p : p + length] = b"\x01" * length
        spans = sum(1 for k in range(len(b)) if cover[k] and (k == 0 or not cover[k - 1]))
        kept = bytes(x for x, c in zip(b, cover, strict=True) if not c)
        out.append((i, len(b), sum(cover), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=repr)


def near_classes(rows, shingles, numerator=4, denominator=5):
    """Per row (doc_id, class_id, n_links): exact Jaccard of all pairs."""
    sets = [shingles(t) for _, t in rows]
    root = list(range(len(rows)))

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    links = [0] * len(rows)
    for a, b in itertools.combinations(range(len(rows)), 2):
        if sets[a] and sets[b]:
            c = len(sets[a] & sets[b])
            if c * denominator >= numerator * (len(sets[a]) + len(sets[b]) - c):
                links[a] += 1
                links[b] += 1
                root[find(a)] = find(b)
    least = {}
    for k, (i, _) in enumerate(rows):
        if i is not None:
            least[find(k)] = min(i, least.get(find(k), i))
    return sorted(((i, least.get(find(k), i), links[k]) for k, (i, _) in enumerate(rows)), key=repr)


def dedup_lines(rows, percent=80):
    """Texts of (doc_id, text) rows without lines that repeat an earlier one."""
    lines, out = [], {}
    for i, t in sorted(rows):
        kept = []
        for line in (t or "").split("\n"):
            s = {w for w in line.lower().translate(BLANKS).split(" ") if w}
            if s and any(len(s & e) * 100 >= len(s | e) * percent for e in lines):
                lines.append(s)
                continue
            lines.append(s) if s else None
            kept.append(line)
        out[i] = "\n".join(kept)
    return out


def contamination(text, items, window=10):
    """(n_words, hit word numbers, ids of occurring items)."""
    w = WORD.findall((text or "").translate(LOWER))
    hit, found = set(), set()
    for item, t in items:
        b = WORD.findall((t or "").translate(LOWER))
        for i in range(max(1, len(b) - window + 1) if b else 0):
            win = b[i : i + window]
            for p in range(len(w) - len(win) + 1):
                if w[p : p + len(win)] == win:
                    hit.update(range(p, p + len(win)))
                    found.add(item)
    return len(w), hit, found


def without_words(text, hit):
    """The text without its hit words and what stands between neighbours."""
    spans = [m.span() for m in WORD.finditer(text.translate(LOWER))]
    out, at, k = [], 0, 0
    while k < len(spans):
        if k in hit:
            out.append(text[at : spans[k][0]])
            while k + 1 in hit:
                k += 1
            at = spans[k][1]
        k += 1
    return "".join(out) + text[at:]
