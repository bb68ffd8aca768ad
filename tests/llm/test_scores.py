import zlib

import numpy as np
import pyarrow as pa
import pytest

from tests.llm.shared import SF, awkward, documents
from tillstream.llm import lm_score, quality_fm, registry, samples, text, toxicity

BIG = "/root/testdata/sf0.1"


def accuracy(spark, query, label):
    got = query(spark, BIG).toPandas()
    known = spark.read.parquet(f"{BIG}/labels.parquet").toPandas()
    assert got.score.between(0, 1).all() and (got.predicted == (got.score >= 0.5)).all()
    held = got[got.held_out].merge(known, on="doc_id")
    return held, ((held[label] == 1) == (held.predicted == 1)).mean()


def test_toxicity_on_the_held_out_fold(spark):
    held, right = accuracy(spark, registry.op4_toxicity, "toxic")
    assert right > 0.95 and len(held) > 500  # a few hundred toxic examples in four languages
    assert all(zlib.crc32(str(i).encode()) % 5 == 0 for i in held.doc_id)
    clean = held[held.toxic == 0]
    assert (clean.predicted == 0).mean() > 0.99


def test_quality_on_the_held_out_fold(spark):
    held, right = accuracy(spark, registry.op6_quality_classifier, "quality")
    assert right > 0.97 and len(held) > 800
    assert all(zlib.crc32(str(i).encode()) % 3 == 1 for i in held.doc_id)


def labels(spark, rows):
    return spark.createDataFrame(rows, "doc_id long, quality int, toxic int")


@pytest.mark.parametrize("operator", [toxicity, quality_fm])
def test_awkward_rows_and_missing_labels(spark, operator):
    rows = [*awkward(), (1, "another text under a known id"), (1, "and one more")]
    docs = documents(spark, rows).selectExpr("*", "'x' as SCORE", "2 as label", "3 as _of")
    for known in ([], [(1, 1, 1), (1, 0, 0), (None, 1, 1), (5, None, None)], [(1, 1, 1), (4, 0, 0), (5, 0, 0), (9, 1, 1), (3, 0, 0), (7, 1, 1)]):
        model = operator.fit(docs, labels(spark, known))
        got = operator.with_scores(docs, model).collect()
        assert len(got) == len(rows)
        scores = {}
        for r in got:
            assert 0 <= r.score <= 1
            scores.setdefault(r.text or "", set()).add(r.score) if operator is toxicity else None
        assert all(len(s) == 1 for s in scores.values())
    assert operator.with_scores(documents(spark, []), operator.fit(documents(spark, []), labels(spark, []))).count() == 0


def test_word_hashes_follow_the_words():
    w = text.words_of(pa.array(["Aa b", None, "", "aa\tB", "b", "é É", "x" * 5000, "x" * 5001]))
    assert np.diff(w.first).tolist() == [2, 0, 0, 2, 1, 2, 1, 1]
    h = w.hashes
    assert h[0] == h[2] and h[1] == h[3] == h[4] and h[5] != h[6] and h[7] != h[8]
    assert len(text.words_of(pa.array([], pa.string())).hashes) == 0


def test_factorisation_machine_equals_the_sum_over_pairs():
    draw = np.random.default_rng(1)
    model = quality_fm.Model(0.3, draw.normal(size=quality_fm.INPUTS), draw.normal(size=(quality_fm.INPUTS, quality_fm.FACTORS)) * 0.1)
    at, x, o = quality_fm.inputs(pa.array(["one two two\nthree", None, "4 !"]), np.array([17.0, 0, 3]))
    got = quality_fm.predicted(model, at, x, o)
    for d in range(3):
        i, v = at[o[d] : o[d + 1]], x[o[d] : o[d + 1]]
        total = model.bias + sum(model.weights[a] * b for a, b in zip(i, v))
        total += sum((model.vectors[i[p]] @ model.vectors[i[q]]) * v[p] * v[q] for p in range(len(i)) for q in range(p))
        assert got[d] == pytest.approx(1 / (1 + np.exp(-total)))


def test_sparse_weights():
    draw = np.random.default_rng(2)
    examples = [np.unique(np.append(draw.integers(0, 5000, 30), 7 if i % 2 else 9)) for i in range(400)]
    model = toxicity.train(examples, np.arange(400) % 2 * 1.0, np.ones(400))
    weight = dict(zip(model.slots.tolist(), model.weights.tolist()))
    assert weight[7] > 0 > weight[9] and len(model.slots) < 500


def test_training_equals_the_textbook_algorithm():
    """FTRL-proximal with a dictionary for each sum, one coordinate at a time."""
    draw = np.random.default_rng(9)
    examples = [np.unique(draw.integers(0, 40, 6)) for _ in range(60)]
    labels, weights = draw.integers(0, 2, 60).astype(float), draw.uniform(0.5, 2, 60)
    z, n = {"bias": 0.0}, {"bias": 0.0}

    def weight(i):
        if i == "bias":
            return -z[i] / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA)
        if abs(z.get(i, 0.0)) <= toxicity.L1:
            return 0.0
        sign = 1 if z[i] > 0 else -1
        return -(z[i] - sign * toxicity.L1) / ((toxicity.BETA + n[i] ** 0.5) / toxicity.ALPHA + toxicity.L2)

    order = np.random.default_rng(5)
    for _ in range(toxicity.EPOCHS):
        for e in order.permutation(60):
            at = ["bias", *examples[e].tolist()]
            now = {i: weight(i) for i in at}
            p = 1 / (1 + np.exp(-sum(now.values())))
            g = weights[e] * (p - labels[e])
            for i in at:
                sigma = ((n.get(i, 0.0) + g * g) ** 0.5 - n.get(i, 0.0) ** 0.5) / toxicity.ALPHA
                z[i] = z.get(i, 0.0) + g - sigma * now[i]
                n[i] = n.get(i, 0.0) + g * g
    model = toxicity.train(examples, labels, weights)
    wanted = {i: weight(i) for i in z if i != "bias" and weight(i) != 0}
    assert dict(zip(model.slots.tolist(), model.weights)) == pytest.approx(wanted, rel=1e-9)
    assert wanted and model.bias == pytest.approx(weight("bias"), rel=1e-9)


def test_a_sample_is_bounded_by_bytes(spark):
    rows = spark.range(50).selectExpr("id as doc_id", "cast(repeat('x', 100) as binary) as a", "cast('yy' as binary) as b")
    kept = samples.within_bytes(rows, ["a", "b"], 1050)
    assert kept.columns == ["doc_id", "a", "b"] and kept.count() == 10
    assert samples.within_bytes(rows, ["a"], 1).count() == 1 and samples.within_bytes(rows.limit(0), ["a"], 1).count() == 0


def test_a_row_without_an_id_is_not_held_out(spark):
    scored = spark.createDataFrame([(None, 0.7), (3, 0.2)], "doc_id long, score double")
    told = registry.judged(scored, samples.fold("doc_id", 3) == 1).collect()
    assert told[0].held_out is False and [r.predicted for r in told] == [1, 0] and isinstance(told[1].held_out, bool)


COUNTS = np.random.default_rng(1).zipf(1.3, lm_score.TOKENS)


def test_likelihood_equals_a_plain_computation(spark):
    net, tree = lm_score.fresh(3), lm_score.tree_of(COUNTS)
    ids = np.array([3, 900, 1023, 3, 40, 5], np.uint16)
    at = np.array([0, 4, 6])
    got = lm_score.log_probs(net, tree, lm_score.neighbours(ids, at, np.arange(6)), ids)
    for t in range(6):
        d = 0 if t < 4 else 1
        h = net.shift.astype(float).copy()
        for k, step in enumerate(lm_score.PLACES):
            there = t + step
            h += net.rows[k][ids[there] if at[d] <= there < at[d + 1] else lm_score.TOKENS]
        h = np.tanh(h)
        told = 0.0
        for place in range(tree.first[ids[t]], tree.first[ids[t] + 1]):
            x = h @ net.nodes[tree.nodes[place]] + net.node_shift[tree.nodes[place]]
            told -= np.log1p(np.exp(-tree.signs[place] * x))
        assert got[t] == pytest.approx(told, abs=1e-4)


def test_probabilities_of_all_tokens_add_up_to_one():
    draw = np.random.default_rng(6)
    for counts in (COUNTS, np.zeros(5, np.int64), np.array([7, 1]), np.arange(100)):
        tree = lm_score.tree_of(counts)
        size = lm_score.Sizes(len(counts), 1)
        net = lm_score.Network(*[draw.normal(0, 1, s).astype(np.float32) for s in lm_score.shapes(size)])
        around = np.repeat(draw.integers(0, len(counts) + 1, (4, 1)), len(counts), axis=1)
        assert np.exp(lm_score.log_probs(net, tree, around, np.arange(len(counts)))).sum() == pytest.approx(1, abs=1e-4)


def test_ways_are_as_short_as_huffman_makes_them():
    import heapq

    heap = [(int(c), i) for i, c in enumerate(np.maximum(COUNTS, 1))]
    heapq.heapify(heap)
    least = 0
    while len(heap) > 1:
        a, b = heapq.heappop(heap), heapq.heappop(heap)
        least += a[0] + b[0]
        heapq.heappush(heap, (a[0] + b[0], -len(heap)))
    tree = lm_score.tree_of(COUNTS)
    assert (np.diff(tree.first) * np.maximum(COUNTS, 1)).sum() == least


def test_gradient_is_that_of_the_loss():
    net, tree = lm_score.fresh(4), lm_score.tree_of(COUNTS)
    draw = np.random.default_rng(4)
    ids = draw.integers(0, lm_score.TOKENS, 50).astype(np.uint16)
    around = lm_score.neighbours(ids, np.array([0, 50]), np.arange(50))
    g = lm_score.gradient(net, tree, around, ids)
    node = int(tree.nodes[tree.first[ids[5]]])
    for part, at in ((0, (1, int(around[1][7]), 3)), (2, (node, 2)), (3, (node,)), (1, (5,)), (2, (lm_score.TOKENS - 2, 1))):
        values = []
        for move in (1e-2, -1e-2):
            other = lm_score.Network(*[x.astype(np.float64) for x in net])
            other[part][at] += move
            values.append(-lm_score.log_probs(other, tree, around, ids).mean())
        assert g[part][at] == pytest.approx((values[0] - values[1]) / 2e-2, abs=2e-5)


def test_gradient_by_tiles_equals_a_plain_computation():
    """Whole and broken tiles, tokens that repeat, and ways of very different length."""
    draw = np.random.default_rng(8)
    for counts, n in ((COUNTS, 1), (COUNTS, 300), (2 ** np.arange(40), 5 * lm_score.TILE), (np.array([7, 1]), 50)):
        size, tree = lm_score.Sizes(len(counts), 1), lm_score.tree_of(counts)
        net = lm_score.Network(*[draw.normal(0, 1, s).astype(np.float32) for s in lm_score.shapes(size)])
        ids = np.minimum(draw.zipf(1.3, n) - 1, len(counts) - 1).astype(np.uint16)
        around = lm_score.neighbours(ids, np.array([0, n]), np.arange(n), size.tokens)
        wanted = lm_score.Network(*[np.zeros(s) for s in lm_score.shapes(size)])
        for t in range(n):
            h = np.tanh(net.shift + sum(net.rows[k][around[k][t]].astype(float) for k in range(4)))
            dh = np.zeros(lm_score.HIDDEN)
            for at in range(tree.first[ids[t]], tree.first[ids[t] + 1]):
                node, sign = tree.nodes[at], float(tree.signs[at])
                d = -sign / (1 + np.exp(sign * (h @ net.nodes[node] + net.node_shift[node]))) / n
                dh += d * net.nodes[node]
                wanted.nodes[node] += d * h
                wanted.node_shift[node] += d
            wanted.shift[:] += dh * (1 - h * h)
            for k in range(4):
                wanted.rows[k][around[k][t]] += dh * (1 - h * h)
        got = lm_score.gradient(net, tree, around, ids)
        assert all(np.allclose(a, b, atol=2e-5) for a, b in zip(got, wanted))


def test_a_tile_meets_each_of_its_nodes_once():
    """What a step costs: as many rows of nodes as tiles have different nodes, not one for each position and node."""
    tree = lm_score.tree_of(COUNTS)
    ids = np.minimum(np.random.default_rng(9).zipf(1.3, 1000) - 1, lm_score.TOKENS - 1).astype(np.uint16)
    w = lm_score.walk(tree, ids)
    sorted_ids = ids[w.place]
    ways = [set(tree.nodes[tree.first[t] : tree.first[t + 1]].tolist()) for t in sorted_ids]
    wanted = [sorted(set().union(*ways[a : a + lm_score.TILE])) for a in range(0, 1000, lm_score.TILE)]
    got = [sorted(w.of[w.slot // w.slots == tile].tolist()) for tile in range(w.tiles)]
    assert got == wanted and len(w.of) < sum(map(len, ways)) / 3
    assert len(w.cell) == sum(map(len, ways)) == len(set(w.cell.tolist()))


def test_what_tasks_send_does_not_outgrow_the_texts():
    """Whatever the number of input splits: tasks times parameters stay within a small multiple of the words' bytes."""
    for words in (10**8, 10**10, 10**13):
        size = lm_score.sizes(words)
        sent = lm_score.training_tasks(words, size) * 4 * sum(int(np.prod(s)) for s in lm_score.shapes(size))
        assert sent <= 1.01 * words * lm_score.WORD_BYTES


def test_training_takes_no_more_tasks_than_asked_for(spark):
    rows = documents(spark, [(i, "a b c d e f") for i in range(64)]).repartition(16)
    size = lm_score.LEAST
    counts = lm_score.stored(lm_score.word_counts(rows, "text"), "w")
    top = lm_score.frequent_words(counts, size)
    tokens = lm_score.encoded(rows, "text", top["word"].to_numpy().view(text.U), size)
    tree = lm_score.tree_of(lm_score.token_counts(counts, top, size))
    few = lm_score.trained(tokens, size, tree, tasks=2, rounds=1)
    alone = lm_score.trained(tokens.coalesce(2), size, tree, rounds=1)
    assert all(np.allclose(a, b, atol=1e-4) for a, b in zip(few, alone))
    # Rows that no task touched are as they began.
    untouched = size.known - 1
    assert (few.rows[0][untouched] == lm_score.fresh().rows[0][untouched]).all()


def test_likelihood_prefers_the_order_of_the_corpus(spark):
    rows = [(i, " ".join(["the cat sat on a mat"] * 40)) for i in range(200)]
    rows += [(1000, " ".join(["mat on the a sat cat"] * 40)), (1001, None), (1002, " "), (None, "the cat"), (1, "the cat")]
    docs = documents(spark, rows).selectExpr("*", "1 as ids", "2 as LOG_PROB")
    got = lm_score.with_likelihood(docs).toPandas()
    assert len(got) == len(rows)
    by = got.set_index("doc_id")
    assert by.mean_log_prob[5] > by.mean_log_prob[1000]
    assert (by.n_tokens[1001], by.log_prob[1001]) == (0, 0) and np.isnan(by.mean_log_prob[1002])
    assert lm_score.with_likelihood(documents(spark, [])).count() == 0


def test_likelihood_query_covers_all_words(spark):
    got = {r.doc_id: r for r in registry.op2_lm_score(spark, SF).collect()}
    for row in spark.read.parquet(f"{SF}/documents.parquet").collect():
        r = got[row.doc_id]
        assert r.n_tokens == len(row.text.split()) and r.log_prob < 0
        assert r.mean_log_prob == pytest.approx(r.log_prob / r.n_tokens)


def test_words_outside_the_vocabulary_have_their_own_probability(spark):
    def hashed(names):
        return text.words_of(pa.array(names)).hashes.view(np.int64)

    size = lm_score.LEAST
    often = [f"often{i}" for i in range(size.known)]
    rare = [f"rare{i}" for i in range(size.slots + 1)]
    slot = hashed(rare) % size.slots
    a, b = next((i, j) for j in range(len(rare)) for i in range(j) if slot[i] == slot[j])
    rows = [(1, rare[a]), (2, rare[b]), (3, " ".join(often * 6)), (4, " ".join([rare[b]] * 4)), (5, often[0])]
    got = {r.doc_id: r for r in lm_score.with_likelihood(documents(spark, rows)).collect()}
    # Both stand alone in the same slot, one of them five times as often.
    assert got[1].log_prob - got[2].log_prob == pytest.approx(np.log(1 / 5))


def test_vocabulary_grows_with_the_corpus():
    assert lm_score.sizes(0).tokens == lm_score.TOKENS
    small, large = lm_score.sizes(4_000_000), lm_score.sizes(400_000_000)
    assert small.tokens >= 4000 and large.tokens >= 9.5 * small.tokens
    assert small.known > 0.9 * small.tokens
    net = lm_score.fresh(size=lm_score.Sizes(15, 2))
    assert net.rows.shape[1] == 16 and net.nodes.shape == (14, lm_score.HIDDEN)


def test_every_position_is_trained_once():
    at = np.array([0, 7, 7, 8, 30])
    found = np.concatenate([lm_score.places_of(at, turn, lm_score.ROUNDS) for turn in range(lm_score.ROUNDS)])
    assert sorted(found.tolist()) == list(range(30))
    # The same positions of a document, whatever stands before it in its block.
    alone = lm_score.places_of(np.array([0, 22]), 1, lm_score.ROUNDS)
    assert lm_score.places_of(at, 1, lm_score.ROUNDS)[-len(alone) :].tolist() == (alone + 8).tolist()
