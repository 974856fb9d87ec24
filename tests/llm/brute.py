"""Plain versions of the operators, for small tables."""

import math
import re
import zlib
from collections import Counter, defaultdict
from hashlib import sha256

import numpy as np


def sha(text):
    return sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def crc(doc_id, n):
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % n


def lower_words(text):
    return (text or "").encode().lower().split()


def contamination(docs, items):
    word = re.compile(rb"[0-9a-z\x80-\xff]+")
    windows = defaultdict(set)
    for item, text in items:
        w = word.findall((text or "").encode().lower())
        for k in range(max(1, len(w) - 12) if w else 0):
            windows[tuple(w[k:k + 13])] |= set() if item is None else {str(item)}
    out = []
    for doc_id, text in docs:
        w = word.findall((text or "").encode().lower())
        hit, found = set(), set()
        for n in {len(k) for k in windows}:
            for k in range(len(w) - n + 1):
                if (held := windows.get(tuple(w[k:k + n]))) is not None:
                    hit.update(range(k, k + n))
                    found |= held
        out.append((doc_id, len(w), len(hit), len(found), sha(",".join(sorted(found))),
                    len(hit) > 0 and 20 * len(hit) >= len(w)))
    return out


def ppm(docs, order=5):
    counts, trie, streams = Counter(), [defaultdict(Counter) for _ in range(order + 1)], []
    for doc_id, text in docs:
        words = lower_words(text)
        stream = b" ".join(words) + b"\n"
        streams.append((doc_id, words, stream))
        if crc(doc_id, 10):
            counts.update(words)
            counts[b"\n"] += 1
            padded = b"\0" * order + stream
            for j in range(order, len(padded)):
                for k in range(order + 1):
                    trie[k][padded[j - k:j]][padded[j]] += 1
    n, v = sum(counts.values()), len(counts)
    out = []
    for doc_id, words, stream in streams:
        tokens = [*words, b"\n"]
        base = sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in tokens)
        padded, score = b"\0" * order + stream, 0.0
        for j in range(order, len(padded)):
            gone = set()
            for k in range(order, -1, -1):
                node = {a: c for a, c in trie[k].get(padded[j - k:j], {}).items() if a not in gone}
                if not node:
                    continue
                total, kinds = sum(node.values()), len(node)
                if padded[j] in node:
                    score += math.log10(node[padded[j]] / (total + kinds))
                    break
                score += math.log10(kinds / (total + kinds))
                gone |= set(node)
            else:
                score -= math.log10(256 - len(gone))
        out.append((doc_id, not crc(doc_id, 10), len(tokens), sum(counts[w] > 0 for w in tokens), n, base, score))
    return out


def substrings(docs, length=50):
    first = {}
    out = []
    by_id = defaultdict(list)
    for doc_id, text in docs:
        by_id[doc_id].append((text or "").encode())
    for doc_id in sorted(by_id, key=lambda d: (d is None, d)):
        new = set()
        for b in by_id[doc_id]:
            gone = np.zeros(len(b), bool)
            for s in range(len(b) - length + 1) if doc_id is not None else ():
                part = b[s:s + length]
                if part in first:
                    gone[s:s + length] = True
                new.add(part)
            spans = int((gone & ~np.append(False, gone[:-1])).sum()) if len(b) else 0
            out.append((doc_id, len(b), int(gone.sum()), spans, sha(np.frombuffer(b, np.uint8)[~gone].tobytes())))
        for part in new:
            first.setdefault(part, doc_id)
    return out


def winnowed(text, hashes, k=12, window=24):
    chars = np.array([ord(c) + 1 for c in text], np.uint64)
    if not len(chars):
        return [], []
    h = hashes(chars, min(k, len(chars))).tolist()
    chosen = []
    for i in range(max(1, len(h) - window + 1)):
        part = h[i:i + window]
        p = i + max(j for j, v in enumerate(part) if v == min(part))
        if not chosen or chosen[-1] != p:
            chosen.append(p)
    return chosen, [h[p] for p in chosen]


def rendered(positions, hashes):
    out, last = "", -1
    for p, h in zip(positions, hashes):
        out += f"{p - last:02x}{h:08x}"
        last = p
    return out


def jaccard(a, b):
    a, b = set(a), set(b)
    return 1.0 if not a and not b else len(a & b) / len(a | b)


def shingles(text, words):
    w = lower_words(text)
    if len(w) < words:
        return frozenset([tuple(w)]) if w else frozenset()
    return frozenset(tuple(w[k:k + words]) for k in range(len(w) - words + 1))


def near(docs, words, percent=80):
    """Rows with one id are one document; all pairs of documents are compared."""
    sets = [(d, shingles(t, words)) for d, t in docs]
    ids = sorted({d for d, _ in sets if d is not None})
    parent = {d: d for d in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    some = [(d, s) for d, s in sets if d is not None and s]
    for i, (a, s) in enumerate(some):
        for b, t in some[:i]:
            common = len(s & t)
            if a != b and 100 * common >= percent * (len(s) + len(t) - common):
                x, y = sorted((find(a), find(b)))
                parent[y] = x
    out = []
    for d, s in sets:
        component = d if not s else None if d is None else find(d)
        out.append((d, len(s), component, d == component if d is not None and component is not None else True))
    return out


def spelling(docs):
    run, counts = re.compile("[A-Za-zÀ-ÿ]+"), Counter()
    for doc_id, text in docs:
        for found in run.findall(text or ""):
            word = "".join(c.lower() if c.isascii() else c for c in found)
            h = zlib.crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if h % 31 == 0:
                at = h % len(word)
                word = word[:at] + word[at + 1:]
            counts[word] += 1
    words = sorted(w for w, n in counts.items() if len(w) >= 7 and n >= 2)
    holes = defaultdict(set)
    for w in words:
        for k in range(len(w)):
            holes[w[:k] + "\0" + w[k + 1:]].add(w)  # replaced
            holes[w[:k] + w[k + 1:]].add(w)  # deleted
        holes[w].add(w)
    near = defaultdict(set)
    for key, held in holes.items():
        for w in held:
            near[w] |= {x for x in held if x != w and ("\0" in key or abs(len(x) - len(w)) == 1)}
    form = {}
    for w in words:
        best = min(near[w], key=lambda x: (-counts[x], x), default=None)
        form[w] = best if best is not None and counts[best] >= 10 * counts[w] else None
    out = []
    for w in words:
        root = w
        while form[root] is not None:
            root = form[root]
        out.append((w, form[w], root, counts[w], len(near[w]), None if form[w] is None else counts[form[w]]))
    return out


def ordered_turns(rows):
    """``conv_id -> [(role, text)]``; rows are ``(conv_id, turn, role, text)``."""
    out = defaultdict(list)
    for conv, turn, role, text in sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2] or "", r[3] or "")):
        out[conv].append((role or "", text or ""))
    return out


def trie(rows):
    own = ordered_turns([r for r in rows if r[0] is not None])
    whole = {}
    for c, turns in own.items():
        h = zlib.crc32(str(c).encode()) % 6
        base = c - (abs(c) % 100) * (1 if c >= 0 else -1)
        whole[c] = own.get(base, [])[:h] + turns[h:]
    members = defaultdict(list)
    for c, turns in sorted(whole.items()):
        for d in range(len(turns) + 1):
            members[tuple(turns[:d])].append(c)
    children = Counter(p[:-1] for p in members if p)
    leaves, saved = Counter(), Counter()
    for p, held in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(held) - 1) * len(p[-1][1]) if p else 0
    return [(held[0], len(p), members[p[:-1]][0] if p else None, len(held), children[p], leaves[p], saved[p],
             sha(",".join(str(c) for c in held if len(whole[c]) == len(p)))) for p, held in members.items()]


def chat(rows):
    """All but ``formatted_chars``."""
    out = []
    for conv, turns in ordered_turns(rows).items():
        loss = "".join(text for role, text in turns if role == "assistant")
        out.append((conv, len(turns), sha("".join(f"{role}\n{text}\n" for role, text in turns)), len(loss), sha(loss)))
    return out
