"""Brute-force counterparts of the operators, in plain Python, for small tables."""

import hashlib
import re

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def remove_repeats(rows, window=13):
    """rows: (doc_id, text). Returns (doc_id, n_words, n_removed, sha256 of the kept words)."""
    first = {}
    split = [(i, WORD.findall(t or "")) for i, t in rows]
    for i, words in split:
        if i is not None:
            for k in range(len(words) - window + 1):
                gram = tuple(words[k : k + window])
                first[gram] = min(first.get(gram, i), i)
    found = []
    for i, words in split:
        gone = set()
        for k in range(len(words) - window + 1):
            gram = tuple(words[k : k + window])
            if gram in first and (i is None or first[gram] < i):
                gone.update(range(k, k + window))
        kept = " ".join(w for k, w in enumerate(words) if k not in gone)
        found.append((i, len(words), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return found


def contamination(rows, items, window=10):
    """(doc_id, n_words, n_hit, n_items, sha256 of the item ids, contaminated)."""

    def lowered(text):
        text = re.sub("[A-Z]", lambda m: m.group().lower(), text or "")
        return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", text)

    owners = {}
    for item, text in items:
        words = lowered(text)
        size = min(window, len(words))
        for k in range(len(words) - size + 1 if size else 0):
            owners.setdefault(size, {}).setdefault(tuple(words[k : k + size]), set()).add(item)
    found = []
    for i, text in rows:
        words, hit, names = lowered(text), set(), set()
        for size, windows in owners.items():
            for k in range(len(words) - size + 1):
                if (gram := tuple(words[k : k + size])) in windows:
                    hit.update(range(k, k + size))
                    names |= windows[gram]
        names = sorted(str(n) for n in names if n is not None)
        digest = hashlib.sha256(",".join(names).encode()).hexdigest()
        found.append((i, len(words), len(hit), len(names), digest, bool(hit)))
    return found


def base_counts(text, window=5):
    """n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words."""
    text = text or ""
    words = WORD.findall(text)
    lines = [line for line in text.split("\n") if WORD.search(line)]
    places = {}
    for k in range(len(words) - window + 1):
        places.setdefault(tuple(words[k : k + window]), []).append(k)
    repeated = {k + j for at in places.values() if len(at) > 1 for k in at for j in range(window)}
    return (
        len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)),
        len(lines) - len(set(lines)), len(repeated),
    )


def near_duplicates(rows, size=5, percent=85):
    """(doc_id, n_shingles, component_id, kept); ids are distinct and not None."""
    sets = {}
    for i, text in rows:
        words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        n = min(size, len(words))
        sets[i] = {tuple(words[k : k + n]) for k in range(len(words) - n + 1)} if n else set()
    holders, root = {}, {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in sorted(sets):
        common = {}
        for shingle in sets[i]:
            for other in holders.setdefault(shingle, []):
                common[other] = common.get(other, 0) + 1
            holders[shingle].append(i)
        for other, both in common.items():
            if 100 * both >= percent * (len(sets[i]) + len(sets[other]) - both):
                low, high = sorted((find(i), find(other)))
                root[high] = low
    return [(i, len(s), find(i), find(i) == i) for i, s in sets.items()]


ASSIGN = re.compile(
    r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A
)


def base_secrets(text):
    """kind:start:end of the base patterns, ordered by start, then kind."""
    text = text or ""
    found = [(m.start(), 0, "assign", m.end()) for m in ASSIGN.finditer(text) if len(m.group(2)) >= 6]
    found += [(m.start(), 1, "access", m.end()) for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m.group()) >= 20]
    found += [(m.start(), 2, "hex", m.end()) for m in re.finditer(r"[0-9a-f]+", text) if len(m.group()) >= 24]
    return ",".join(f"{kind}:{start}:{end}" for start, _, kind, end in sorted(found))
