"""Documents with every awkward case, and brute-force versions of the operators."""

import hashlib
import re

DOCS = "doc_id long, text string, lang string, source string, n_chars long, kept string, score string, shard string, size string, key string, level string"
LONG = " ".join(f"w{i % 97}x{i % 89}" for i in range(30000))

TEXTS = [
    (1, "The quick brown fox jumps over the lazy dog and runs into the deep green forest near the river bank", "en", "a"),
    (2, "the QUICK  brown fox jumps over the lazy dog and runs into the deep\tgreen forest near the river bank", "en", "b"),
    (3, "The quick brown fox jumps over the lazy dog and runs into the deep green forest near the river bank", "en", "a"),
    (4, None, "en", "a"),
    (5, "", None, None),
    (6, "   \t\n ", "de", "b"),
    (7, "word", "de", "c"),
    (7, "word", "de", "c"),
    (7, "another text of the same id", "de", "c"),
    (None, "no id at all", "fr", None),
    (None, None, None, None),
    (8, LONG, "en", "a"),
    (9, LONG + " end", "en", "é"),
    (10, "un deux", "fr", "b"),
    (11, "first paragraph\nsecond paragraph\nthird", "en", "\U0001f600"),
    (12, "third\nfirst paragraph\nsecond paragraph", "en", "b"),
    (13, "12345 67890 \U0001f600 漢字", None, "c"),
    (14, "11 22 -- 33", "de", "c"),
]


def docs(spark, texts=TEXTS):
    """The documents, with extra columns whose names operators use themselves."""
    rows = [(i, t, la, s, len(t or ""), "x", "y", "z", "w", "v", "u") for i, t, la, s in texts]
    return spark.createDataFrame(rows, DOCS)


def empty(spark):
    return spark.createDataFrame([], DOCS)


def by_all(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: tuple((x is None, str(x)) for x in r))


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


def least(ids):
    """Smallest id; null ids come last."""
    known = [i for i in ids if i is not None]
    return min(known) if known else None


def normalised(text):
    return re.sub(r"[\x20\x09-\x0D]+", " ", text or "")


def removed(texts, length):
    """Removed bytes of each text (id, bytes): every byte of a string that also starts in a smaller id's text."""
    first = {}
    order = lambda i: (i is None, i or 0)
    for i, t in texts:
        for p in range(len(t) - length + 1):
            w = t[p : p + length]
            first[w] = min(first.get(w, order(i)), order(i))
    out = []
    for i, t in texts:
        gone = bytearray(len(t))
        for p in range(len(t) - length + 1):
            if first[t[p : p + length]] < order(i):
                gone[p : p + length] = b"\x01" * length
        spans = sum(1 for k in range(len(gone)) if gone[k] and (k == 0 or not gone[k - 1]))
        out.append((i, len(t), sum(gone), spans, sha(bytes(b for b, g in zip(t, gone, strict=True) if not g))))
    return out


def shingles(text, width):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return frozenset()
    return frozenset(tuple(words[i : i + width]) for i in range(max(1, len(words) - width + 1)))


def linked_components(texts, width, threshold):
    """(id, set size, smallest id reachable, links) of each text by comparing all pairs."""
    sets = [shingles(t, width) for _, t in texts]
    near = [[] for _ in texts]
    for x in range(len(texts)):
        for y in range(len(texts)):
            if x != y and sets[x] and sets[y]:
                both = len(sets[x] & sets[y])
                if both >= threshold * (len(sets[x]) + len(sets[y]) - both) and both:
                    near[x].append(y)
    out = []
    for x, (i, _) in enumerate(texts):
        seen, todo = {x}, [x]
        while todo:
            for y in near[todo.pop()]:
                if y not in seen:
                    seen.add(y)
                    todo.append(y)
        out.append((i, len(sets[x]), least(texts[y][0] for y in seen), len(near[x])))
    return out
