"""Brute-force versions of the operators, in plain Python."""

import hashlib
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def words(text):
    return WORD.findall(text or "")


def fingerprint(text, shingle=4):
    found = words(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not found:
        return 0
    parts = [" ".join(found[i:i + shingle]) for i in range(max(1, len(found) - shingle + 1))]
    hashes = [xxhash.xxh64_intdigest(part.encode(), 42) for part in parts]
    return sum(1 << bit for bit in range(64) if 2 * sum(h >> bit & 1 for h in hashes) > len(hashes))


def groups(prints, radius=4):
    """The least fingerprint reachable from each."""
    parent = {p: p for p in prints}

    def find(p):
        while parent[p] != p:
            p = parent[p]
        return p

    listed = sorted(parent)
    for at, a in enumerate(listed):
        for b in listed[:at]:
            if (a ^ b).bit_count() <= radius:
                x, y = find(a), find(b)
                parent[max(x, y)] = min(x, y)
    return {p: find(p) for p in listed}


def near_duplicates(rows, radius=4):
    prints = [fingerprint(text) for _, text in rows]
    root = groups(set(prints), radius)
    least = {}
    for (doc_id, _), p in zip(rows, prints):
        if doc_id is not None:
            least[root[p]] = min(doc_id, least.get(root[p], doc_id))
    return [(doc_id, f"{p:016x}", least.get(root[p])) for (doc_id, _), p in zip(rows, prints)]


def _order(row):
    doc_id, text = row
    return (doc_id is not None, doc_id or 0)


def substring(rows, window=20):
    """(doc_id, n_words, n_removed, digest), documents in order of id, equal rows being one document."""
    import struct

    def key(row):
        # The library breaks ties of the id by the signed hash of the text.
        raw = xxhash.xxh64_intdigest((row[1] or "").encode(), 42)
        return (*_order(row), struct.unpack("<q", struct.pack("<Q", raw))[0])

    seen, found = {}, {}
    for row in sorted(set(rows), key=key):
        listed = words(row[1])
        gone = [False] * len(listed)
        for at in range(len(listed) - window + 1):
            part = tuple(listed[at:at + window])
            if part in seen:
                gone[at:at + window] = [True] * window
            seen.setdefault(part, at)
        kept = [w for w, g in zip(listed, gone) if not g]
        found[row] = (len(listed), sum(gone), hashlib.sha256(" ".join(kept).encode()).hexdigest())
    return [(row[0], *found[row]) for row in rows]


def suffix(rows, length=400):
    counts = Counter()
    for _, text in rows:
        data = (text or "").encode()
        counts.update(data[i:i + length] for i in range(len(data) - length + 1))
    found = []
    for doc_id, text in rows:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - length + 1):
            if counts[data[i:i + length]] > 1:
                gone[i:i + length] = b"\1" * length
        kept = bytes(b for b, g in zip(data, gone) if not g)
        spans = len(re.findall(b"\1+", bytes(gone)))
        found.append((doc_id, len(data), sum(gone), spans, hashlib.sha256(kept).hexdigest()))
    return found


def leaks(rows, items, size=5, similarity=0.8):
    """{(doc_id, item_id): best similarity} over all windows of the item's size."""

    def shingles(text):
        found = words((text or "").lower())
        return found, lambda width: [tuple(found[i:i + width]) for i in range(len(found) - width + 1)]

    best = {}
    for doc_id, text in rows:
        _, of_doc = shingles(text)
        for item_id, item in items:
            listed, of_item = shingles(item)
            if not listed:
                continue
            width = min(size, len(listed))
            wanted = Counter(of_item(width))
            count = sum(wanted.values())
            parts = of_doc(width)
            if not wanted.keys() & set(parts):
                continue
            for at in range(len(parts)):
                own = Counter(parts[at:at + count])
                common = sum((own & wanted).values())
                score = common / (sum(own.values()) + count - common)
                if score >= similarity - 1e-12:
                    best[doc_id, item_id] = max(score, best.get((doc_id, item_id), 0))
    return best


def secrets(text):
    text = text or ""
    assign = re.compile(
        r"""((?ai:password|passwd|secret|token|api_?key))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""")
    found = [(m.start(), 0, m.end()) for m in assign.finditer(text) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", text) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", text) if len(m[0]) >= 32]
    return [(("assign", "access", "hex")[kind], start, end) for start, kind, end in sorted(found)]


def measures(text):
    found, lines = words(text), [line for line in (text or "").split("\n") if WORD.search(line)]
    threes = [tuple(found[i:i + 3]) for i in range(len(found) - 2)]
    counts = Counter(threes)
    covered = {i + k for i, three in enumerate(threes) if counts[three] > 1 for k in range(3)}
    return (len(found), sum(map(len, found)), sum(c in "#*$%&|<>" for c in text or ""),
            len(lines) - len(set(lines)), len(covered))


def smallest_capacity(sizes, shards):
    def fits(capacity):
        used, room = 1, capacity
        for size in sizes:
            if size > capacity:
                return False
            if size > room:
                used, room = used + 1, capacity
            room -= size
        return used <= shards

    low, high = 1, max(1, sum(sizes))
    while low < high:
        middle = (low + high) // 2
        low, high = (low, middle) if fits(middle) else (middle + 1, high)
    return low


def by_key(pairs):
    found = defaultdict(list)
    for key, value in pairs:
        found[key].append(value)
    return found


def byte_bpe(text, ranks, pattern):
    """Ids of a text: pieces whole if they are tokens, else the least rank first, leftmost of equals."""
    found = []
    for piece in pattern.findall(text or ""):
        data = piece.encode()
        parts = [data] if data in ranks else [bytes([b]) for b in data]
        while len(parts) > 1:
            of_pairs = [ranks.get(a + b, 1 << 60) for a, b in zip(parts, parts[1:])]
            at = of_pairs.index(min(of_pairs))
            if of_pairs[at] == 1 << 60:
                break
            parts[at:at + 2] = [parts[at] + parts[at + 1]]
        found += [ranks[part] for part in parts]
    return found


def aligned(rows, a, a_bytes, b, b_bytes):
    """(doc_id, n_a, n_b, n_groups, n_links, n_best, count_sum, digest) from whole texts and all overlaps."""

    def spans(ids, bytes_of):
        at, found = 0, []
        for number in ids:
            found.append((number, at, at + len(bytes_of[number])))
            at = found[-1][2]
        return found, b"".join(bytes_of[i] for i in ids)

    docs = []
    for doc_id, text in rows:
        tokens_a = tokens_b = ()
        if text:
            tokens_a, joined_a = spans(a.encode(" " + text, add_special_tokens=False).ids, a_bytes)
            tokens_b, joined_b = spans(b.encode(text), b_bytes)
            if not joined_a == joined_b == (" " + text).encode():
                tokens_a = tokens_b = ()
        links, first = [], 0
        for i, start, end in tokens_a:
            while first < len(tokens_b) and tokens_b[first][2] <= start:
                first += 1
            at = first
            while at < len(tokens_b) and tokens_b[at][1] < end:
                links.append((i, tokens_b[at][0]))
                at += 1
        docs.append((doc_id, tokens_a, tokens_b, links))
    counts = Counter(link for *_, links in docs for link in links)
    most = defaultdict(int)
    for (_, of_b), n in counts.items():
        most[of_b] = max(most[of_b], n)
    found = []
    for doc_id, tokens_a, tokens_b, links in docs:
        cuts = sorted({t[2] for t in tokens_a} & {t[2] for t in tokens_b})
        sides = []
        for tokens in (tokens_a, tokens_b):
            grouped, at = [[] for _ in cuts], 0
            for i, _, end in tokens:
                grouped[at].append(str(i))
                at += end == cuts[at]
            sides.append([",".join(group) for group in grouped])
        shown = ";".join(f"{x}|{y}" for x, y in zip(*sides))
        found.append((
            doc_id, len(tokens_a), len(tokens_b), len(cuts), len(links),
            sum(counts[link] == most[link[1]] for link in links), sum(counts[link] for link in links),
            hashlib.sha256(shown.encode()).hexdigest() if tokens_a else "",
        ))
    return found


def one_edit(a, b):
    if len(a) > len(b):
        a, b = b, a
    if len(b) - len(a) > 1 or a == b:
        return False
    at = next((i for i, (x, y) in enumerate(zip(a, b)) if x != y), len(a))
    return a[at + (len(a) == len(b)):] == b[at + 1:]


def spelling(rows, every=31, least=7, twice=2, factor=10):
    """(word, form, root, n, n_near, form_n) by comparing all pairs of words."""
    import zlib

    counts = Counter()
    for doc_id, text in rows:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = re.sub("[A-Z]", lambda m: m[0].lower(), run)
            check = zlib.crc32(f"{'' if doc_id is None else doc_id}:{run}".encode())
            if check % every == 0:
                at = check % len(run)
                run = run[:at] + run[at + 1:]
            counts[run] += 1
    counts = {word: n for word, n in counts.items() if len(word) >= least and n >= twice}
    near = defaultdict(list)
    listed = sorted(counts)
    for at, a in enumerate(listed):
        for b in listed[:at]:
            if abs(len(a) - len(b)) < 2 and one_edit(a, b):
                near[a].append(b)
                near[b].append(a)
    form = {}
    for word, others in near.items():
        best = min(others, key=lambda other: (-counts[other], other))
        if counts[best] >= factor * counts[word]:
            form[word] = best

    def root(word):
        while word in form:
            word = form[word]
        return word

    return [(w, form.get(w), root(w), counts[w], len(near[w]), counts.get(form.get(w))) for w in listed]
