"""Plain one-machine versions of the operators' results."""

import hashlib
import re
import zlib
from collections import defaultdict

import xxhash

SPACED = re.compile(r"[^\x20\x09-\x0D]+")
ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
UPPER = {c: c + 32 for c in range(0x41, 0x5B)}


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def contamination(texts, items, window=13):
    """n_words, n_hit and names of items for every text."""
    words = [(name, ALNUM.findall((t or "").translate(UPPER))) for name, t in items]
    windows = defaultdict(set)
    for name, w in words:
        size = min(window, len(w))
        for i in range(len(w) - size + 1 if w else 0):
            windows[tuple(w[i : i + size])].add(name)
    sizes = {len(w) for w in windows}
    out = []
    for text in texts:
        w = ALNUM.findall((text or "").translate(UPPER))
        hit, names = set(), set()
        for size in sizes:
            for i in range(len(w) - size + 1):
                if found := windows.get(tuple(w[i : i + size])):
                    hit.update(range(i, i + size))
                    names |= found
        out.append((len(w), len(hit), names))
    return out


def simhash(text):
    words = SPACED.findall((text or "").translate(UPPER))
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(len(words) - 2, 1))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def grouped(prints, bits=3):
    """The smallest reachable id for every (id, fingerprint), None last."""
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            root[i] = root[root[i]]
            i = root[i]
        return i

    for i, (_, a) in enumerate(prints):
        for j in range(i):
            if (a ^ prints[j][1]).bit_count() <= bits:
                root[find(i)] = find(j)
    least = {}
    for i, (name, _) in enumerate(prints):
        if name is not None:
            least[find(i)] = min(name, least.get(find(i), name))
    return [least.get(find(i)) for i in range(len(prints))]


def repeated_units(sequences, window):
    """For every sequence the set of its places covered by a window that starts elsewhere too."""
    starts = defaultdict(list)
    for d, seq in enumerate(sequences):
        for i in range(len(seq) - window + 1):
            starts[seq[i : i + window]].append((d, i))
    covered = [set() for _ in sequences]
    for places in starts.values():
        if len(places) > 1:
            for d, i in places:
                covered[d].update(range(i, i + window))
    return covered


def crc_mod5(name):
    return zlib.crc32(str(name).encode()) % 5
