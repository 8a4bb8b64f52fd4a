"""The contamination rule word by word, for tests of other modules."""

import re


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def contaminated(text, items):
    w, found, whole = words(text), set(), False
    grams = {tuple(w[p : p + k]) for k in range(1, 9) for p in range(len(w) - k + 1)}
    for i, t in items:
        v = words(t)
        size = min(8, len(v))
        if size and any(tuple(v[p : p + size]) in grams for p in range(len(v) - size + 1)):
            found.add(i)
            whole |= size == 8
    return whole or len(found) >= 2
