"""Plain Python versions that the operators are compared with."""

import hashlib
import re
from collections import defaultdict

import numpy as np
import regex
import xxhash

BLANKS = " \t\n\x0b\f\r"
UPPER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def base_secrets(text):
    """Counts by kind and digest of the base spans."""
    text = text or ""
    assign = re.compile(
        r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
        re.IGNORECASE | re.ASCII,
    )
    spans = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 6]
    spans += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    spans += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 24]
    names = ("assign", "access", "hex")
    counts = tuple(sum(kind == one for _, kind, _ in spans) for one in range(3))
    return *counts, sha(",".join(f"{names[kind]}:{a}:{b}" for a, kind, b in sorted(spans)))


def line_dedup(docs):
    """doc rows -> (doc_id, lines, dropped, digest) as a list in the same order."""
    key = lambda line: line.strip(BLANKS).translate(UPPER)
    owners = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(key(line)) >= 20:
                owners[key(line)].add(doc_id)
    found = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        kept = [
            line for line in lines
            if len(owners.get(key(line), ())) < 3
            or max((one for one in owners[key(line)] if one is not None), default=None) == doc_id
        ]
        found.append((doc_id, len(lines), len(lines) - len(kept), sha("\n".join(kept))))
    return found


def simhash(text):
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[at:at + 4]) for at in range(max(1, len(words) - 3))]
    counts = [0] * 64
    for shingle in shingles:
        value = xxhash.xxh64_intdigest(shingle, 42)
        for bit in range(64):
            counts[bit] += value >> bit & 1
    return sum(1 << bit for bit in range(64) if 2 * counts[bit] > len(shingles))


def smallest_reachable(ids, linked):
    """Smallest id of each row's connected component, given a boolean matrix."""
    parent = list(range(len(ids)))

    def find(at):
        while parent[at] != at:
            parent[at] = parent[parent[at]]
            at = parent[at]
        return at

    for a, b in np.argwhere(np.triu(linked, 1)):
        parent[find(a)] = find(b)
    best = {}
    for at, one in enumerate(ids):
        if one is not None:
            best[find(at)] = min(best.get(find(at), one), one)
    return [best.get(find(at)) for at in range(len(ids))]


def tokens(text):
    return regex.findall(r"[\p{L}\p{N}]+", (text or "").lower())


def leaks(docs, items, window=13, equal=11):
    """{(doc_id, item_id): most equal tokens in an aligned window} by sliding every item."""
    numbers = {}
    code = lambda words: np.array([numbers.setdefault(w, len(numbers)) for w in words], int)
    found = {}
    coded = [(item_id, code(tokens(text))) for item_id, text in items]
    for doc_id, text in docs:
        own = code(tokens(text))
        for item_id, item in coded:
            if not len(item) or np.isin(item, own).sum() < min(equal, len(item)):
                continue
            pad = np.full(len(item), -1)
            whole = np.concatenate((pad, own, pad))
            same = np.lib.stride_tricks.sliding_window_view(whole, len(item)) == item
            if len(item) < window:
                best = len(item) if same.all(axis=1).any() else 0
            else:
                sums = np.concatenate((np.zeros((len(same), 1), int), same.cumsum(axis=1)), axis=1)
                best = int((sums[:, window:] - sums[:, :-window]).max())
            if best >= min(equal, len(item)):
                found[doc_id, item_id] = best
    return found
