"""Importance resampling against counting by hand."""

import hashlib
import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa

from tests.conftest import rows
from tests.llm.shared import awkward, documents, prose
from tillstream.llm import resampling

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def features(text):
    w = words(text)
    return [" ".join(w[i : i + n]) for n in (1, 2, 3) for i in range(len(w) - n + 1)]


def bucket(feature):
    return zlib.crc32(feature.encode()) % 10000


def by_hand(docs, target):
    ours, aim = Counter(), Counter()
    for _, text in docs:
        ours.update(map(bucket, features(text)))
    for text in target:
        aim.update(map(bucket, features(text)))
    s_all, t_all = sum(ours.values()), sum(aim.values())
    gain = {b: math.floor(1000 * math.log((aim[b] + 1) * (s_all + 10000) / ((ours[b] + 1) * (t_all + 10000)))) for b in ours}
    out = []
    for i, text in docs:
        found = features(text)
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        weight = sum(gain[bucket(f)] for f in found)
        out.append([i, len(words(text)), len(found), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    fit = sorted((r for r in out if r[1] >= 20), key=lambda r: (-r[4], r[0] is None, r[0]))
    for place, row in enumerate(fit[: 5 * len(fit) // 100], 1):
        row[5] = place
    return sorted(map(tuple, out), key=repr)


LINES = ["one", "two words", "three words here", "and four words here", "- - -", "", "five of them stand here", "Ünï ÉTÉ x1", "one", "z" * 90]


def lined(seed, n):
    chosen = random.Random(seed)
    return "\n".join(chosen.choice(LINES) for _ in range(n))


def test_all_columns_by_hand(spark):
    docs = awkward() + [(100 + i, lined(i, i % 12 + 1) + " " + " ".join(prose(i, i % 30))) for i in range(80)]
    docs += [(500, lined(1, 40)), (500, lined(1, 40)), (None, lined(1, 40)), (7, "\r\n".join(prose("cr", 30)))]
    target = ["One two", lined(5, 9), None, "", "five of\nthem stand"]
    frame = documents(spark, docs)
    found = resampling.resampled(frame, documents(spark, list(enumerate(target))))
    told = rows(found, "doc_id", *resampling.COLUMNS)
    assert told == by_hand(docs, target)
    assert sum(r[-1] is not None for r in told) >= 3


def test_small_blocks_and_many_parts(spark, monkeypatch):
    """Distinct lines are weighed per block; where blocks end doesn't matter, nor how rows are spread."""
    docs = [(i, lined(i, 15)) for i in range(300)]
    frame = documents(spark, docs).repartition(7)
    monkeypatch.setattr(resampling, "MIN_WORDS", 20)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        found = resampling.resampled(frame, documents(spark, [(1, "five of them stand here one two")]), keep=["doc_id"])
        assert rows(found, "doc_id", *resampling.COLUMNS) == by_hand(docs, ["five of them stand here one two"])
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")


def test_one_id_and_score_in_all_rows_is_spread(spark):
    docs = documents(spark, [(1, " ".join(prose("same", 25)))] * 400).repartition(4)
    ranks = [r["rank"] for r in resampling.resampled(docs, documents(spark, [])).collect()]
    assert sorted(r for r in ranks if r is not None) == list(range(1, 21))


def test_no_rows_and_clashing_names(spark):
    docs = documents(spark, [(1, " ".join(prose(1, 30)))]).withColumnRenamed("source", "Rank").withColumnRenamed("lang", "_spread2")
    made = resampling.resampled(docs, documents(spark, []))
    assert made.columns == ["doc_id", "text", "_spread2", "n_chars", *resampling.COLUMNS]
    assert made.count() == 1
    assert resampling.resampled(documents(spark, []), documents(spark, [(1, "a")])).collect() == []
    assert resampling.feature_counts(documents(spark, [(1, None)])).sum() == 0


def test_checksums_of_runs_equal_the_library():
    texts = ["a bc " + "d" * 63 + " " + "e" * 64 + " " + "f" * 65 + " " + "g" * 5000 + " h", "", "ü é z", "-"]
    found = resampling.words_of(pa.array(texts))
    assert found.first.tolist() == [0, 7, 7, 10, 10]
    told = Counter()
    for buckets, _, _ in resampling.features(found):
        told.update(buckets.tolist())
    assert told == Counter(bucket(f) for t in texts for f in features(t))


def test_appending_zero_bytes():
    crc = np.array([zlib.crc32(b"abc")], np.uint32)
    for n in (0, 1, 63, 64, 65, 1000, 70_000):
        tail = b"x" * n
        assert int(resampling.shifted(crc, np.array([n]))[0]) ^ zlib.crc32(tail) == zlib.crc32(b"abc" + tail)
