"""Plain versions of the operators, for small tables."""

import collections
import hashlib
import itertools
import math
import re
import zlib

import numpy as np
import public_tokenizers
from tokenizers import Tokenizer

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return WORD.findall((text or "").translate(LOWER))


def shingles(text, k=5):
    w = words(text)
    return {tuple(w[i : i + k]) for i in range(max(1, len(w) - k + 1))} if w else set()


def token_ids(name, texts, end):
    tokenizer = Tokenizer.from_file(public_tokenizers.path(name))
    tokenizer.encode_special_tokens = True
    return [x.ids + [end] for x in tokenizer.encode_batch([t or "" for t in texts], add_special_tokens=False)]


def crc(ids):
    return zlib.crc32(np.array(ids, "<u4").tobytes())


class Sets:
    def __init__(self, items):
        self.up = {x: x for x in items}

    def find(self, x):
        while self.up[x] != x:
            x = self.up[x]
        return x

    def join(self, a, b):
        a, b = self.find(a), self.find(b)
        self.up[max(a, b)] = min(a, b)


def near_components(docs, percent=85):
    """docs: (doc_id, text). doc_id -> smallest doc_id of its component."""
    sets = {i: shingles(t) for i, t in docs}
    groups = Sets(sets)
    for a, b in itertools.combinations(sets, 2):
        both = len(sets[a] & sets[b])
        if both and 100 * both >= percent * len(sets[a] | sets[b]):
            groups.join(a, b)
    return {i: groups.find(i) for i in sets}


def repeated(docs, least=50):
    """(doc_id, first word, words) of the passages made of windows of ``least`` words that occur twice."""
    texts = [(i, words(t)) for i, t in docs]
    seen = {}
    for _, w in texts:
        for a in range(len(w) - least + 1):
            key = tuple(w[a : a + least])
            seen[key] = seen.get(key, 0) + 1
    out = []
    for i, w in texts:
        covered = [False] * len(w)
        for a in range(len(w) - least + 1):
            if seen[tuple(w[a : a + least])] > 1:
                covered[a : a + least] = [True] * least
        at = 0
        for value, run in itertools.groupby(covered):
            n = len(list(run))
            if value:
                out.append((i, at, n))
            at += n
    return out


def edit_distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a):
        new = [i + 1]
        for j, y in enumerate(b):
            new.append(min(row[j] + (x != y), row[j + 1] + 1, new[-1] + 1))
        row = new
    return row[-1]


def trie(rows, rebuild=True):
    """rows: (conv_id, turn, role, text, hash of role and text). The nodes of the prefix trie, as tuples."""
    by = collections.defaultdict(list)
    for c, turn, role, text, tie in rows:
        by[c].append(((turn is not None, turn or 0), role or "", tie, text or ""))
    own = {c: [(role, text) for _, role, _, text in sorted(v)] for c, v in by.items()}
    whole = {}
    for c, v in own.items():
        h = zlib.crc32(str(c).encode()) % 9 if rebuild and c is not None else 0
        whole[c] = (own.get(c - c % 5, [])[:h] if h else []) + v[h:]
    members, children = collections.defaultdict(list), collections.defaultdict(list)
    for c in sorted(whole, key=lambda c: (c is None, c)):
        for d in range(len(whole[c]) + 1):
            members[tuple(whole[c][:d])].append(c)
    for p in members:
        if p:
            children[p[:-1]].append(p)
    out = {}
    for p in sorted(members, key=len, reverse=True):
        n = len(members[p])
        ends = ",".join("" if c is None else str(c) for c in members[p] if len(whole[c]) == len(p))
        saved = sum(out[x][6] for x in children[p]) + ((n - 1) * len(p[-1][1].encode()) if p else 0)
        leaves = sum(out[x][5] for x in children[p]) or 1
        out[p] = (members[p][0], len(p), None, n, len(children[p]), leaves, saved, hashlib.sha256(ends.encode()).hexdigest())
    return [(*v[:2], members[p[:-1]][0] if p else None, *v[3:]) for p, v in out.items()]


def resampled(docs, target, runs=1, buckets=10_000, percent=10, least=20, seed=2024):
    """docs: (doc_id, text). (doc_id, n_features, weight, score, rank) of each."""
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

    def features(text):
        w = word.findall((text or "").translate(LOWER))
        grams = [" ".join(w[i : i + n]) for n in range(1, runs + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(g.encode()) % buckets for g in grams]

    found = [(i, *features(t)) for i, t in docs]
    s = collections.Counter(x for f in found for x in f[2])
    t = collections.Counter(x for y in target for x in features(y)[1])
    docs_n, target_n = sum(s.values()) + buckets, sum(t.values()) + buckets
    gain = [math.floor(1000 * math.log((t[x] + 1) * docs_n / ((s[x] + 1) * target_n))) for x in range(buckets)]
    rows = []
    for i, n_words, own in found:
        weight = sum(gain[x] for x in own) // len(own) if own else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        rows.append((n_words, i, len(own), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296)))))
    fit = sorted((k for k, r in enumerate(rows) if r[0] >= least), key=lambda k: (-rows[k][4], rows[k][1] is not None, rows[k][1], rows[k][2]))
    rank = {k: n + 1 for n, k in enumerate(fit[: percent * len(fit) // 100])}
    return [(*r[1:], rank.get(k)) for k, r in enumerate(rows)]
