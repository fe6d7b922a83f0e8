"""Plain Python versions of the operators, for small tables."""

from __future__ import annotations

import hashlib
import re
import zlib
from collections import Counter

ALNUM = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
SPACED = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def alnum_words(text):
    return ALNUM.findall((text or "").translate(LOWER))


def contamination(docs, items, window=10):
    """[(doc_id, n_words, n_hit, items)] of docs [(doc_id, text)]."""
    owners = {}
    for name, text in items:
        w = alnum_words(text)
        for i in range(max(1, len(w) - window + 1) if w else 0):
            owners.setdefault(tuple(w[i:i + window]), set()).add(name)
    lengths = {len(k) for k in owners}
    out = []
    for doc_id, text in docs:
        w = alnum_words(text)
        hit, found = set(), set()
        for n in lengths:
            for i in range(len(w) - n + 1):
                key = tuple(w[i:i + n])
                if key in owners:
                    hit.update(range(i, i + n))
                    found |= owners[key]
        out.append((doc_id, len(w), len(hit), sorted(str(x) for x in found if x is not None)))
    return out


def nearby(docs, items, window=10, span=20, least=6):
    """{doc_id: items with a window, cut without overlap, whose distinct words all stand within ``span`` words}."""
    sets = set()
    for name, text in items:
        w = alnum_words(text)
        for i in {*range(0, len(w) - window + 1, window), max(0, len(w) - window)}:
            if len(set(w[i:i + window])) >= least and name is not None:
                sets.add((frozenset(w[i:i + window]), str(name)))
    out = {}
    for doc_id, text in docs:
        w = alnum_words(text)
        stretches = [frozenset(w[i:i + span]) for i in range(max(1, len(w) - span + 1))]
        words = set(w)
        out.setdefault(doc_id, set()).update(name for s, name in sets if s <= words and any(s <= x for x in stretches))
    return {d: sorted(x) for d, x in out.items()}


def repeats(docs, window=20):
    """[(doc_id, n_words, n_removed, kept_sha256)]: words covered by a window that starts earlier elsewhere."""
    rows = sorted(docs, key=lambda r: r[0])
    first = {}
    split = []
    for k, (doc_id, text) in enumerate(rows):
        w = SPACED.findall(text or "")
        split.append(w)
        for i in range(len(w) - window + 1):
            first.setdefault(tuple(w[i:i + window]), (k, i))
    out = []
    for k, (doc_id, _) in enumerate(rows):
        w = split[k]
        gone = set()
        for i in range(len(w) - window + 1):
            if first[tuple(w[i:i + window])] != (k, i):
                gone.update(range(i, i + window))
        kept = " ".join(x for i, x in enumerate(w) if i not in gone)
        out.append((doc_id, len(w), len(gone), hashlib.sha256(kept.encode()).hexdigest()))
    return out


def shingles(text, k):
    w = SPACED.findall((text or "").translate(LOWER))
    if not w:
        return frozenset()
    return frozenset(tuple(w[i:i + k]) for i in range(max(1, len(w) - k + 1)))


def components(docs, k=2, percent=80):
    """[(doc_id, n_shingles, component_id, kept)] by a full pairwise join."""
    sets = [(d, shingles(t, k)) for d, t in docs]
    up = list(range(len(sets)))

    def root(i):
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    by_word = {}
    for i, (_, s) in enumerate(sets):
        for x in s:
            by_word.setdefault(x, []).append(i)
    for i, (_, s) in enumerate(sets):
        shared = {}
        for x in s:
            for j in by_word[x]:
                if j < i:
                    shared[j] = shared.get(j, 0) + 1
        for j, n in shared.items():
            if 100 * n >= percent * (len(s) + len(sets[j][1]) - n):
                up[root(i)] = root(j)
    least = {}
    for i, (d, _) in enumerate(sets):
        least[root(i)] = min(least.get(root(i), d), d)
    return [(d, len(s), least[root(i)], d == least[root(i)]) for i, (d, s) in enumerate(sets)]


def line_dedup(docs, percent=80):
    """[(doc_id, n_lines, n_removed, kept_sha256)] by comparing each line with all earlier ones."""
    earlier, by_word, out = [], {}, []
    for doc_id, text in sorted(docs, key=lambda r: r[0]):
        lines = text.split("\n") if text else []
        kept = []
        for line in lines:
            words = frozenset(SPACED.findall(line.translate(LOWER)))
            shared = {}
            for w in words:
                for j in by_word.get(w, ()):
                    shared[j] = shared.get(j, 0) + 1
            if not any(100 * n >= percent * (len(words) + len(earlier[j]) - n) for j, n in shared.items()):
                kept.append(line)
            if words:
                for w in words:
                    by_word.setdefault(w, []).append(len(earlier))
                earlier.append(words)
        out.append((doc_id, len(lines), len(lines) - len(kept), hashlib.sha256("\n".join(kept).encode()).hexdigest()))
    return out


def license_scan(text, sentences, rules, gap):
    """(number of sentences, [(rule, licence, first, last)]) of one text."""
    names = {" ".join(alnum_words(s)): name for name, s in sentences.items()}
    kept = [n for n in (" ".join(alnum_words(x)) for x in re.split(r"[.!?;:](?=[\t-\r ]|\Z)|\n", text or "")) if n]
    found = [(i, names[n]) for i, n in enumerate(kept) if n in names]
    out, i = [], 0
    while i < len(found):
        for rule, name, wanted in rules:
            part = found[i:i + len(wanted)]
            if [n for _, n in part] == wanted and all(part[k + 1][0] - part[k][0] <= gap + 1 for k in range(len(part) - 1)):
                out.append((rule, name, part[0][0], part[-1][0]))
                i += len(wanted)
                break
        else:
            i += 1
    return len(kept), out


def token_files(docs, encode, end_id=1):
    """[(doc_id, start, n_tokens, ids_crc32)] of docs [(doc_id, text)] in ascending doc_id order, by plain calls of ``encode``."""
    out, at = [], 0
    for doc_id, text in sorted(docs, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = [*encode(text or ""), end_id]
        out.append((doc_id, at, len(ids), zlib.crc32(b"".join(i.to_bytes(4, "little") for i in ids))))
        at += len(ids)
    return out


def digest(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def merkle(rows, fanout=16):
    """[(doc_id, leaf, subroot, root, proof_sha256, folded_root, verified)] of rows (doc_id, text, lang, source, n_chars)."""
    def leaf(doc_id, text, lang, source, n_chars):
        return digest(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)])

    def tree(digests):
        """(root, [path of each]); a path is [(left, right)]."""
        levels = [digests]
        while len(levels[-1]) > 1:
            last = levels[-1]
            levels.append([digest(*last[i:i + fanout]) for i in range(0, len(last), fanout)])
        paths = []
        for i in range(len(digests)):
            path = []
            for level in levels[:-1]:
                run = i // fanout * fanout
                path.append(("".join(level[run:i]), "".join(level[i + 1:run + fanout])))
                i //= fanout
            paths.append(path)
        return levels[-1][0], paths

    groups = {}
    for r in rows:
        groups.setdefault(r[3], []).append((r, leaf(*r)))
    order = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    for held in groups.values():
        held.sort(key=lambda x: (x[0][0] is not None, x[0][0] or 0, x[1]))
    trees = [tree([x for _, x in groups[s]]) for s in order]
    root, upper = tree([t[0] for t in trees]) if trees else (None, [])
    out = []
    for source, (subroot, paths), above in zip(order, trees, upper, strict=True):
        for (r, own), path in zip(groups[source], paths, strict=True):
            changed = list(r)
            if r[0] is not None and zlib.crc32(str(r[0]).encode()) % 5 == 0 and r[1] is not None:
                changed[1] = r[1].translate(LOWER)
            acc = leaf(*changed)
            for left, right in path + above:
                acc = digest(left, acc, right)
            out.append((r[0], own, subroot, root, digest(*[x + y for x, y in path + above]), acc, acc == root))
    return out


def alignment(docs, encode_a, bytes_a, encode_b, bytes_b):
    """[(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, groups_sha256)] of docs [(doc_id, text)]."""
    held, counts = [], Counter()
    for doc_id, text in docs:
        sides, whole = [], bool(text)
        for encode, as_bytes in ((encode_a, bytes_a), (encode_b, bytes_b)) if whole else ():
            spans, at = [], 0
            for i in encode(text):
                spans.append((i, at, at + len(as_bytes[i])))
                at += len(as_bytes[i])
            whole &= b"".join(as_bytes[i] for i, _, _ in spans) == (" " + text).encode()
            sides.append(spans)
        if not whole:
            held.append((doc_id, 0, 0, [], []))
            continue
        a, b = sides
        links, j = [], 0
        for i, s, e in a:
            while b[j][2] <= s:
                j += 1
            k = j
            while k < len(b) and b[k][1] < e:
                links.append((i, b[k][0]))
                k += 1
        ends = sorted({e for *_, e in a} & {e for *_, e in b})
        groups, p, q = [], 0, 0
        for end in ends:
            left, right = [], []
            while p < len(a) and a[p][2] <= end:
                left.append(str(a[p][0]))
                p += 1
            while q < len(b) and b[q][2] <= end:
                right.append(str(b[q][0]))
                q += 1
            groups.append(",".join(left) + "|" + ",".join(right))
        held.append((doc_id, len(a), len(b), groups, links))
        counts.update(set(links))
    best = {}
    for (i, _), n in counts.items():
        best[i] = max(best.get(i, 0), n)
    return [(doc_id, n_a, n_b, len(groups), len(links), sum(counts[x] == best[x[0]] for x in links), sum(counts[x] for x in links),
             hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "") for doc_id, n_a, n_b, groups, links in held]
