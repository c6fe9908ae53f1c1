"""The operators' contracts, spelled out row by row in plain Python."""

import hashlib
import random
import re
from collections import Counter, defaultdict

import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LAST = (1 << 63) - 1


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def sha(text):
    return hashlib.sha256(text if isinstance(text, bytes) else text.encode()).hexdigest()


def key(doc_id):
    return LAST if doc_id is None else doc_id


def base_measures(text):
    text = text or ""
    words, seen, dup = WORD.findall(text), set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    counts = Counter(tuple(words[i : i + 8]) for i in range(len(words) - 7))
    marks = [0] * len(words)
    for i in range(len(words) - 7):
        if counts[tuple(words[i : i + 8])] > 1:
            marks[i : i + 8] = [1] * 8
    failed = len(words) < 20 or 100 * sum(marks) > 30 * len(words)
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), dup, sum(marks), failed


def suffix_dedup(docs, k=50):
    first = {}
    for doc_id, text in docs:
        data = (text or "").encode()
        for i in range(len(data) - k + 1):
            first[data[i : i + k]] = min(key(doc_id), first.get(data[i : i + k], LAST))
    out = []
    for doc_id, text in docs:
        data = (text or "").encode()
        gone = bytearray(len(data))
        for i in range(len(data) - k + 1):
            if first[data[i : i + k]] < key(doc_id):
                gone[i : i + k] = b"\1" * k
        kept = bytes(x for x, g in zip(data, gone, strict=True) if not g)
        out.append((doc_id, len(data), sum(gone), len(re.findall(b"\1+", bytes(gone))), sha(kept)))
    return out


def fingerprint(text):
    words = WORD.findall(lower(text or ""))
    shingles = [" ".join(words[i : i + 4]) for i in range(max(1, len(words) - 3))] if words else []
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def simhash_roots(docs, far=4):
    """Each document's fingerprint and the least one that links reach from it."""
    prints = [fingerprint(text) for _, text in docs]
    root = {p: p for p in prints}

    def find(p):
        while root[p] != p:
            p = root[p]
        return p

    for a in root:
        for b in root:
            if (a ^ b).bit_count() <= far:
                root[max(find(a), find(b))] = min(find(a), find(b))
    return [(p, find(p)) for p in prints]


def simhash(docs, far=4):
    roots = simhash_roots(docs, far)
    least = defaultdict(lambda: LAST)
    for (doc_id, _), (_, r) in zip(docs, roots, strict=True):
        least[r] = min(least[r], key(doc_id))
    return [(doc_id, f"{p:016x}", None if least[r] == LAST else least[r]) for (doc_id, _), (p, r) in zip(docs, roots, strict=True)]


def substring_dedup(docs, k=20):
    words = [WORD.findall(text or "") for _, text in docs]
    first = {}
    for (doc_id, _), w in zip(docs, words, strict=True):
        for i in range(len(w) - k + 1):
            window = tuple(w[i : i + k])
            first[window] = min((key(doc_id), i), first.get(window, (LAST, 1 << 60)))
    out = []
    for (doc_id, _), w in zip(docs, words, strict=True):
        gone = [False] * len(w)
        for i in range(len(w) - k + 1):
            if first[tuple(w[i : i + k])] < (key(doc_id), i):
                gone[i : i + k] = [True] * k
        out.append((doc_id, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone, strict=True) if not g))))
    return out


def decontaminate(docs, items, k=10):
    word = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")
    patterns = defaultdict(set)
    for item, text in items:
        w = word.findall(lower(text or ""))
        for i in range(max(1, len(w) - k + 1) if w else 0):
            patterns[tuple(w[i : i + k])].add("" if item is None else str(item))
    sizes = {len(p) for p in patterns}
    out = []
    for doc_id, text in docs:
        w = word.findall(lower(text or ""))
        hit, names = [False] * len(w), set()
        for n in sizes:
            for i in range(len(w) - n + 1):
                if found := patterns.get(tuple(w[i : i + n])):
                    hit[i : i + n] = [True] * n
                    names |= found
        out.append((doc_id, len(w), sum(hit), len(names), sha(",".join(sorted(names))), any(hit)))
    return out


def line_dedup(docs, least_chars=40, least_docs=5):
    strip = " \t\n\x0b\f\r"
    holders = defaultdict(set)
    for doc_id, text in docs:
        for line in (text or "").split("\n"):
            if len(line.strip(strip)) >= least_chars:
                holders[lower(line.strip(strip))].add(key(doc_id))
    out = []
    for doc_id, text in docs:
        lines = (text or "").split("\n")
        gone = [len(h := holders.get(lower(x.strip(strip)), ())) >= least_docs and max(h) != key(doc_id) for x in lines]
        out.append((doc_id, len(lines), sum(gone), sha("\n".join(x for x, g in zip(lines, gone, strict=True) if not g))))
    return out


def targets(sizes, most=3):
    """source -> target, by sharing the excess until no source is above its cap."""
    order = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: i % 3 + 1 for i, s in enumerate(order)}
    total, fixed = sum(sizes.values()), {}
    while True:
        rest = [s for s in order if s not in fixed]
        left, whole = total - sum(fixed.values()), sum(weight[s] for s in rest)
        over = [s for s in rest if left * weight[s] / whole > most * sizes[s]]
        if not over:
            return fixed | {s: left * weight[s] / whole for s in rest}
        fixed |= {s: most * sizes[s] for s in over}


def maximal_chats(turns):
    """conv -> its (role, text) turns, for conversations that are no prefix of another, the least of equals."""
    by = defaultdict(set)
    for conv, turn, role, text in turns:
        by[key(conv)].add((LAST if turn is None else turn, role, text))
    whole = {c: tuple((r, t) for _, r, t in sorted(x, key=lambda y: (y[0], str(y[1:])))) for c, x in by.items()}
    proper = {w[:n] for w in whole.values() for n in range(1, len(w))}
    out = {}
    for c in sorted(whole):
        if whole[c] not in proper and whole[c] not in out.values():
            out[c] = whole[c]
    return out


def greedy_pieces(word, vocabulary):
    """Longest match first."""
    word, n, at, longest = b" " + word, 0, 0, max(map(len, vocabulary))
    while at < len(word):
        at += next(size for size in range(min(longest, len(word) - at), 0, -1) if word[at : at + size] in vocabulary)
        n += 1
    return n


CLASHES = "id bigint, tag string, part int, spans string, bucket string, n_words string, size string, c0 string, print string, node string, u string, hash string"


def made_documents():
    """Rows (doc_id, text, lang, source, n_chars) with copies, shared passages, nulls, empty and long texts, repeated rows and ties."""
    rng = random.Random(7)
    vocabulary = ["".join(rng.choice("abcdefgéßñ") for _ in range(rng.randint(1, 7))) for _ in range(60)] + ["The", "OF", "x|y", "#tag", "日本", "é"]
    prose = lambda n: "".join(rng.choice(vocabulary) + rng.choice([" ", " ", " ", "  ", "\n", "\t", ". "]) for _ in range(n))
    passage, line = prose(60), "A line that a good many documents of this table do share, word for word"
    rows = [[i, prose(rng.randint(25, 150))] for i in range(40)]
    for i in range(40, 52):
        rows.append([i, prose(20) + passage + prose(rng.randint(0, 30))])
    for i in range(52, 60):
        rows.append([i, f"{prose(10)}\n  {line.upper() if i % 2 else line} \r\n{prose(5)}\n{line}"])
    rows += [[60, rows[3][1]], [61, rows[3][1] + " tail"], [62, rows[40][1][:-30]], [63, "A b c"], [64, "a B c"], [65, ""], [66, None], [67, " \n\t \n"], [68, "x"], [69, "12 34 !!"]]
    rows += [[70, "na " * 400], [71, prose(3000) + passage], [72, "w" * 20000], [73, passage + "\n" + passage], [74, "\n".join(["one two three four five six seven eight nine ten"] * 6)], [75, "\x00 nul \x7f del"]]
    rows += [rows[5][:], rows[40][:], [6, "another text under a number that is taken " + passage], [None, rows[7][1]], [None, None], [None, passage + " of no number"]]
    langs, sources = ["en", "de", None, "fr"], ["b", "a", None, "c", "é"]
    return [(i, t, langs[n % 4], sources[n % 5] if n % 3 else "b", None if n % 7 == 0 else len(t or "")) for n, (i, t) in enumerate(rows)]


def with_clashes(spark, rows, schema):
    """A table with further columns whose names operators use themselves."""
    extra = tuple(7 if kind in ("bigint", "int") else "clash" for kind in (c.split()[1] for c in CLASHES.split(", ")))
    return spark.createDataFrame([(*row, *extra) for row in rows], f"{schema}, {CLASHES}").repartition(3)
