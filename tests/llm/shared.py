"""Documents with all the awkward cases, and brute-force counterparts of the operators."""

import re
import zlib
from collections import Counter, defaultdict

from pyspark.sql import types as T

SF = "/root/testdata/sf0.001"
WORD = re.compile(r"[^\x20\x09-\x0d]+")

DOCS = T.StructType(
    [T.StructField(n, t) for n, t in (("doc_id", T.LongType()), ("text", T.StringType()), ("lang", T.StringType()), ("source", T.StringType()), ("n_chars", T.LongType()))]
)


def documents(spark, rows):
    """Rows of (doc_id, text) as a `documents` table."""
    return spark.createDataFrame([(i, t, "en", "s", None if t is None else len(t)) for i, t in rows], DOCS)


def prose(seed, words):
    """Words that hardly repeat, always the same for a seed."""
    return [f"w{zlib.crc32(f'{seed}/{i}'.encode()) % 10**7}" for i in range(words)]


def awkward():
    base = prose("base", 60)
    return [
        (1, " ".join(base)),
        (2, " ".join(base)),
        (2, " ".join(base)),
        (3, " ".join([*base[:58], "other", "end"])),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "Straße ÉTÉ 😀 #tag"),
        (None, " ".join(base)),
        (None, None),
        (9, "long " * 40_000 + "x" * 5000),
        (10, "a b"),
        (11, "A  B"),
    ]


def lowered(text):
    return re.sub("[A-Z]", lambda m: m[0].lower(), text or "")


def shingles(text):
    words = WORD.findall(lowered(text))
    return set(zip(*[words[i:] for i in range(5)])) if len(words) >= 5 else ({tuple(words)} if words else set())


def near_classes(docs):
    """doc_id -> (size of its set, smallest id reachable), by comparing all pairs that share a shingle."""
    sets = {i: shingles(t) for i, t in docs.items()}
    root = {i: i for i in docs}

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    holders = defaultdict(list)
    for i, found in sets.items():
        for s in found:
            holders[s].append(i)
    common = Counter((a, b) for ids in holders.values() for a in ids for b in ids if a < b)
    for (a, b), n in common.items():
        if 100 * n >= 80 * (len(sets[a]) + len(sets[b]) - n):
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {i: (len(sets[i]), find(i)) for i in docs}
