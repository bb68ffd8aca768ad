"""Masked pseudo-likelihood of documents under a small bidirectional network.

Every token is predicted from the two tokens before and the two after it; a document's
score is the sum of these conditional log-probabilities. The network adds a row per
neighbour and place, takes tanh, and walks a Huffman tree of the tokens: at every node on
the way to a token it tells which branch to take, so that a prediction costs some ten
products instead of one for every token, and probabilities still add up to one. A batch
is sorted by leaf and dealt into tiles of a few positions, whose ways share most nodes: the
sums at all nodes of a tile and their gradients are three small matrix products.

Tokens are the most frequent words of the corpus, in a number that grows with the square
root of its words, and hash slots for all others. A word within a slot has the slot's
probability times the word's share of the corpus words in this slot, so that the
probabilities of all words of the corpus add up to one at every position.

Word counts cover all documents. Over the rounds every position of every document is
trained once. Each round, tasks start from the same parameters and train on every
ROUNDS-th position of their documents; each parameter becomes the mean over the tasks that
changed it, weighted by positions. There are no more tasks than keep what they send below
about the size of the texts.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.stage import own_names, stored
from tillstream.llm.text import U, blocks, words_of

TOKENS = 1024
GROWTH = 2
SLOT_SHARE = 16
PLACES = (-2, -1, 1, 2)
HIDDEN = 16
ROUNDS = 2
BATCH = 1 << 12
RATE = 0.1
TILE = 16
CHUNK = 1 << 16
COUNTED = 4 << 20
PIECE = 1 << 13
WORD_BYTES, LEAST_TASKS = 6, 32
PARTS = 64
COLUMNS = ["n_tokens", "log_prob", "mean_log_prob"]
CODED, ROW = "_lm_coded", "_lm_row"


class Sizes(NamedTuple):
    """Tokens below `known` are words, the next `slots` hash slots of all others."""

    tokens: int
    slots: int

    @property
    def known(self) -> int:
        return self.tokens - self.slots


def sizes(words: int) -> Sizes:
    """For a corpus of so many words: GROWTH times their square root as tokens, TOKENS at least."""
    tokens = max(TOKENS, math.ceil(GROWTH * math.sqrt(words)))
    return Sizes(tokens, tokens // SLOT_SHARE)


LEAST = sizes(0)


class Tree(NamedTuple):
    """The way to token t, from its leaf to the root: the nodes from `first[t]` on to `first[t + 1]`, and at each 1 or
    -1 for the branch. `rank[t]` is the token's place among the leaves from left to right."""

    first: np.ndarray
    nodes: np.ndarray
    signs: np.ndarray
    rank: np.ndarray


def tree_of(counts: np.ndarray) -> Tree:
    """Huffman tree of the tokens, which keeps the mean way short. Counts of 0 are as 1."""
    n = len(counts)
    order = np.argsort(counts, kind="stable")
    weight = np.maximum(counts[order], 1).tolist()
    parent, side = np.zeros(2 * n - 1, np.int64), np.ones(2 * n - 1, np.int8)
    leaves, before = [1] * n, [0] * (2 * n - 1)
    leaf, inner = 0, n
    # Joined nodes come in the order of their weights, so that the two lightest are at the heads of two queues.
    for new in range(n, 2 * n - 1):
        total = below = 0
        for sign in (1, -1):
            take_leaf = leaf < n and (inner >= new or weight[leaf] <= weight[inner])
            child = leaf if take_leaf else inner
            leaf, inner = leaf + take_leaf, inner + (not take_leaf)
            parent[child], side[child], before[child] = new, sign, below
            total, below = total + weight[child], below + leaves[child]
        weight.append(total)
        leaves.append(below)
    for child in range(2 * n - 3, -1, -1):
        before[child] += before[parent[child]]
    rank = np.empty(n, np.int64)
    rank[order] = before[:n]
    token, at = order.copy(), np.arange(n)
    tokens, nodes, signs = [], [], []
    while len(at):
        tokens.append(token)
        nodes.append(parent[at] - n)
        signs.append(side[at])
        at = parent[at]
        token, at = token[at < 2 * n - 2], at[at < 2 * n - 2]
    tokens = np.concatenate(tokens)
    by_token = np.argsort(tokens, kind="stable")
    first = np.searchsorted(tokens[by_token], np.arange(n + 1))
    kind = np.uint16 if n <= 1 << 16 else np.int32
    return Tree(first, np.concatenate(nodes)[by_token].astype(kind), np.concatenate(signs)[by_token], rank.astype(kind))


class Network(NamedTuple):
    rows: np.ndarray  # place, token (the last is "no neighbour"), hidden
    shift: np.ndarray
    nodes: np.ndarray  # node, hidden
    node_shift: np.ndarray


def shapes(size: Sizes) -> tuple[tuple[int, ...], ...]:
    return (len(PLACES), size.tokens + 1, HIDDEN), (HIDDEN,), (size.tokens - 1, HIDDEN), (size.tokens - 1,)


def flat(net: Network) -> np.ndarray:
    return np.concatenate([x.ravel() for x in net])


def shaped(values: np.ndarray, size: Sizes) -> Network:
    ends = np.cumsum([int(np.prod(s)) for s in shapes(size)])
    return Network(*[x.reshape(s).copy() for x, s in zip(np.split(values, ends[:-1]), shapes(size))])


def fresh(seed: int = 2, size: Sizes = LEAST) -> Network:
    draw = np.random.default_rng(seed)
    rows, shift, nodes, node_shift = shapes(size)
    start = [draw.normal(0, 0.1, s).astype(np.float32) for s in (rows, nodes)]
    return Network(start[0], np.zeros(shift, np.float32), start[1], np.zeros(node_shift, np.float32))


def word_counts(docs: DataFrame, text: str) -> DataFrame:
    """word (its hash), n: how often each word stands in all documents."""

    def counted(parts: list[np.ndarray]) -> pa.RecordBatch:
        hashes = np.sort(np.concatenate(parts))
        first = np.flatnonzero(np.append(True, hashes[1:] != hashes[:-1]))
        times = np.diff(np.append(first, len(hashes)))
        return pa.RecordBatch.from_arrays([pa.array(hashes[first].view(np.int64)), pa.array(times)], ["word", "n"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for block in blocks(batch.column(0)):
                held.append(words_of(block).hashes)
                size += len(held[-1])
                if size >= COUNTED:
                    yield counted(held)
                    held, size = [], 0
        if size:
            yield counted(held)

    counts = docs.select(F.col(text).alias("text")).mapInArrow(count, "word long, n long")
    return counts.groupBy("word").agg(F.sum("n").alias("n"))


def frequent_words(counts: DataFrame, size: Sizes) -> pa.Table:
    """The `known` most frequent words with their counts, the most frequent first."""
    return counts.orderBy(F.col("n").desc(), "word").limit(size.known).toArrow()


def token_type(size: Sizes) -> type:
    return np.uint16 if size.tokens <= 1 << 16 else np.uint32


def token_ids(hashes: np.ndarray, known: np.ndarray, number: np.ndarray, size: Sizes) -> np.ndarray:
    """Number of each word; `known` is sorted and `number` belongs to it."""
    slot = (size.known + hashes.view(np.int64) % size.slots).astype(token_type(size))
    if not len(known):
        return slot
    at = np.minimum(np.searchsorted(known, hashes), len(known) - 1)
    return np.where(known[at] == hashes, number[at], slot)


def encoded(docs: DataFrame, text: str, words: np.ndarray, size: Sizes) -> DataFrame:
    """The rows with a number and CODED: the tokens of the whole text end to end, and the hashes of words in slots."""
    order = np.argsort(words)
    known, number = words[order], order.astype(token_type(size))

    @F.arrow_udf("ids binary, rest array<bigint>")
    def coded(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for batch in batches:
            for block in blocks(batch):
                found = words_of(block)
                ids = token_ids(found.hashes, known, number, size)
                unknown = np.concatenate([[0], np.cumsum(ids >= size.known)])
                own = pa.array([ids[a:b].tobytes() for a, b in zip(found.first[:-1], found.first[1:])], pa.binary())
                rest = pa.array(found.hashes[ids >= size.known].view(np.int64))
                listed = pa.ListArray.from_arrays(pa.array(unknown[found.first], pa.int32()), rest)
                yield pa.StructArray.from_arrays([own, listed], ["ids", "rest"])

    return docs.withColumns({CODED: coded(F.col(text)), ROW: F.monotonically_increasing_id()})


def in_slots(counts: DataFrame, top: pa.Table, size: Sizes) -> DataFrame:
    """word, n, slot of the words that have no token of their own."""
    if len(top):
        n, word = top["n"][-1].as_py(), top["word"][-1].as_py()
        counts = counts.where((F.col("n") < n) | ((F.col("n") == n) & (F.col("word") > word)))
    return counts.withColumn("slot", F.pmod("word", F.lit(size.slots)))


def shares(counts: DataFrame, top: pa.Table, size: Sizes) -> DataFrame:
    """word, share: the logarithm of its part of all corpus words in its slot, for the words in slots."""
    left = in_slots(counts, top, size)
    totals = left.groupBy("slot").agg(F.sum("n").alias("total"))
    return left.join(totals, "slot").select("word", F.log(F.col("n") / F.col("total")).alias("share"))


def token_counts(counts: DataFrame, top: pa.Table, size: Sizes) -> np.ndarray:
    """Corpus words of each token. The driver gets a row for each slot, as it got one for each known word."""
    out = np.zeros(size.tokens, np.int64)
    out[: len(top)] = top["n"].to_numpy()
    for row in in_slots(counts, top, size).groupBy("slot").agg(F.sum("n").alias("n")).collect():
        out[size.known + row["slot"]] = row["n"]
    return out


def neighbours(ids: np.ndarray, at: np.ndarray, places: np.ndarray, none: int = TOKENS) -> np.ndarray:
    """The tokens around the places, `none` where a document ends."""
    doc = np.searchsorted(at, places, "right") - 1
    first, last = at[doc], at[doc + 1]
    out = np.empty((len(PLACES), len(places)), np.int64)
    for k, step in enumerate(PLACES):
        there = places + step
        inside = (there >= first) & (there < last)
        out[k] = np.where(inside, ids[np.clip(there, 0, len(ids) - 1)], none)
    return out


def taken(table: np.ndarray, at: np.ndarray) -> np.ndarray:
    """Rows of a table. All of `at` are within it: "clip" only saves numpy the check, which costs more than the rows."""
    return np.take(table, at, axis=0, mode="clip")


def put(table: np.ndarray, at: np.ndarray, rows: np.ndarray) -> None:
    """Replace rows of a table, each copied as a whole."""
    whole = np.dtype((np.void, table.itemsize * table.shape[1]))
    table.view(whole)[:, 0][at] = rows.view(whole)[:, 0]


def hidden(net: Network, around: np.ndarray) -> np.ndarray:
    total = taken(net.rows[0], around[0]) + net.shift
    for k in range(1, len(PLACES)):
        total += taken(net.rows[k], around[k])
    return np.tanh(total)


def log_sigmoid(z: np.ndarray) -> np.ndarray:
    return np.minimum(z, 0) - np.log1p(np.exp(-np.abs(z)))


def log_probs(net: Network, tree: Tree, around: np.ndarray, token: np.ndarray) -> np.ndarray:
    """Log-probability of each token given its neighbours, level by level from the root for the tokens whose way gets there."""
    out = np.zeros(len(token))
    for a in range(0, len(token), PIECE):
        piece = out[a : a + PIECE]
        place = np.argsort(tree.rank[token[a : a + PIECE]], kind="stable")
        own, t = taken(hidden(net, around[:, a : a + PIECE]), place), token[a : a + PIECE][place].astype(np.int64)
        at, last = tree.first[t + 1] - 1, tree.first[t]
        while len(place):
            node = taken(tree.nodes, at).astype(np.int64)
            x = np.einsum("ij,ij->i", own, taken(net.nodes, node)) + taken(net.node_shift, node)
            piece[place] += log_sigmoid(taken(tree.signs, at) * x)
            on = np.flatnonzero(at > last)
            if len(on) < len(place):
                place, own, at, last = place[on], taken(own, on), at[on], last[on]
            at = at - 1
    return out


class Walk(NamedTuple):
    """The ways of tokens that were sorted by leaf and dealt into tiles of TILE. A tile has a slot for each node on its ways.

    For every node on a way (a visit): `cell`, its place in a table of sorted tokens by slots, node and sign. For every
    slot in use: `slot`, its place among the slots of all tiles, and `of`, its node.
    """

    place: np.ndarray
    tiles: int
    slots: int
    cell: np.ndarray
    node: np.ndarray
    sign: np.ndarray
    slot: np.ndarray
    of: np.ndarray


def walk(tree: Tree, token: np.ndarray) -> Walk:
    place = np.argsort(tree.rank[token], kind="stable")
    n, tiles = len(token), -(-len(token) // TILE)
    token = token[np.append(place, np.repeat(place[-1:], tiles * TILE - n))].astype(np.int64)
    first, root = tree.first[token], tree.first[token + 1] - 1
    left = (root - first).astype(np.int32)
    left[n:] = -1
    depth = np.arange(left.max() + 1, dtype=np.int32)
    valid = depth <= left[:, None]
    at = root[:, None] - depth
    way = np.where(valid, taken(tree.nodes, np.maximum(at, 0)).astype(np.int32), np.int32(-1)).reshape(tiles, TILE, -1)
    # Sorted tokens that pass a node stand next to each other, so that a node is new where the token before has another one.
    new = valid.reshape(way.shape).copy()
    new[:, 1:] &= way[:, 1:] != way[:, :-1]
    number = np.cumsum(new.reshape(tiles, -1), axis=1, dtype=np.int32).reshape(way.shape)
    slots = int(number[:, -1, -1].max())
    number = np.maximum.accumulate(np.where(new, number, 0), axis=1) - 1
    visit, made = np.flatnonzero(valid), np.flatnonzero(new)
    number = number.ravel()
    cell, tile = visit // len(depth) * slots + number[visit], made // (TILE * len(depth))
    return Walk(
        place, tiles, slots, cell, way.ravel()[visit], taken(tree.signs, at.ravel()[visit]),
        tile * slots + number[made], way.ravel()[made],
    )


def sums_at(net: Network, w: Walk, h: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The sum at every visit, and the hidden layers and the rows of nodes that it comes from, by tiles."""
    own = taken(h, np.append(w.place, np.repeat(w.place[-1:], w.tiles * TILE - len(w.place)))).reshape(w.tiles, TILE, -1)
    of = np.zeros(w.tiles * w.slots, np.int64)
    of[w.slot] = w.of
    rows = taken(net.nodes, of).reshape(w.tiles, w.slots, -1)
    x = taken((own @ rows.transpose(0, 2, 1)).ravel(), w.cell)
    return x + taken(net.node_shift, w.node), own, rows


def by_row(index: np.ndarray, columns: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct indices and the sums of their values, which come as columns."""
    order = np.argsort(index, kind="stable")
    there = index[order]
    new = np.append(True, there[1:] != there[:-1])
    number = np.empty(len(index), np.int64)
    number[order] = np.cumsum(new) - 1
    touched = there[new]
    slots = np.arange(len(columns))[:, None] * len(touched) + number
    sums = np.bincount(slots.ravel(), columns.ravel(), len(columns) * len(touched))
    return touched, sums.reshape(len(columns), -1).T.astype(np.float32, order="C")


def tables(net: Network) -> tuple[np.ndarray, ...]:
    """The parts of the network as tables of rows, on the same memory."""
    return net.rows.reshape(-1, HIDDEN), net.shift[None], net.nodes, net.node_shift[:, None]


def slopes(net: Network, tree: Tree, around: np.ndarray, token: np.ndarray) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Of the mean negative log-probability: table of the network, rows in it, gradient there; it is 0 elsewhere.

    Rows may be changed as soon as their gradient is out.
    """
    h = hidden(net, around)
    w = walk(tree, token)
    x, own, rows = sums_at(net, w, h)
    d = np.zeros(w.tiles * TILE * w.slots, h.dtype)
    d[w.cell] = -w.sign / (1 + np.exp(w.sign * x)) / np.float32(len(token))
    d = d.reshape(w.tiles, TILE, w.slots)
    of_row = taken((d.transpose(0, 2, 1) @ own).reshape(-1, HIDDEN), w.slot)
    of_shift = d.sum(1).ravel()[w.slot]
    kind = np.uint16 if len(net.nodes) <= 1 << 16 else np.int64
    touched, dx = by_row(w.of.astype(kind), np.concatenate([of_row.T, of_shift[None]]))
    yield 2, touched, dx[:, :-1].copy()
    yield 3, touched, dx[:, -1:].copy()
    dh = np.empty_like(h)
    put(dh, w.place, (d @ rows).reshape(-1, HIDDEN)[: len(token)])
    dh *= 1 - h * h
    yield 1, np.zeros(1, np.int64), dh.sum(0)[None]
    n = net.rows.shape[1]
    kind = np.uint16 if n <= 1 << 16 else np.int64
    columns = dh.T.astype(np.float64, order="C")
    for k in range(len(PLACES)):
        touched, dx = by_row(around[k].astype(kind), columns)
        yield 0, touched.astype(np.int64) + k * n, dx


def gradient(net: Network, tree: Tree, around: np.ndarray, token: np.ndarray) -> Network:
    """Of the mean negative log-probability."""
    g = Network(*[np.zeros(x.shape, np.float32) for x in net])
    for part, at, value in slopes(net, tree, around, token):
        tables(g)[part][at] = value
    return g


def steps(net: Network, seen: Network, tree: Tree, around: np.ndarray, token: np.ndarray) -> None:
    """Gradient steps in place, with a rate for each parameter (Adagrad)."""
    now, squares = tables(net), tables(seen)
    for a in range(0, len(token), BATCH):
        for part, at, dx in slopes(net, tree, around[:, a : a + BATCH], token[a : a + BATCH]):
            s = taken(squares[part], at) + dx * dx
            put(squares[part], at, s)
            put(now[part], at, taken(now[part], at) - RATE * dx / np.sqrt(s))


def documents_in(batches: Iterator[pa.Array], kind: type) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Rows, tokens and offsets of some documents at a time."""
    for batch in batches:
        row = 0
        while row < len(batch):
            held, size = [], 0
            while row < len(batch) and size < CHUNK:
                held.append(np.frombuffer(batch[row].as_py(), kind))
                size += len(held[-1])
                row += 1
            yield len(held), np.concatenate(held), np.concatenate([[0], np.cumsum([len(x) for x in held])])


def places_of(at: np.ndarray, turn: int, rounds: int) -> np.ndarray:
    """The positions to train in a round: each position of a document in exactly one of them."""
    return np.flatnonzero((np.arange(at[-1]) - np.repeat(at[:-1], np.diff(at))) % rounds == turn)


def training_tasks(words: int, size: Sizes) -> int:
    """As many tasks as may each send all parameters without sending more than about the bytes of the texts."""
    parameters = sum(math.prod(s) for s in shapes(size))
    return max(LEAST_TASKS, words * WORD_BYTES // (4 * parameters))


def added(group: pa.Table) -> pa.Table:
    """Sums of a part's changes and of their weights."""
    sums = [pa.array([sum(np.frombuffer(x.as_py(), np.float32) for x in group[c]).tobytes()], pa.binary()) for c in ("change", "weight")]
    return pa.table({"part": group["part"][:1], "salt": group["salt"][:1], "change": sums[0], "weight": sums[1]})


def trained(tokens: DataFrame, size: Sizes, tree: Tree, tasks: int = 1 << 30, rounds: int = ROUNDS) -> Network:
    """Train on every position of all documents, averaging what the tasks changed after each round."""
    net = fresh(size=size)
    for turn in range(rounds):
        start = net

        def local(batches: Iterator[pa.RecordBatch], start=start, turn=turn) -> Iterator[pa.RecordBatch]:
            mine = Network(*[x.copy() for x in start])
            seen = Network(*[np.full(x.shape, 1e-6, np.float32) for x in start])
            used, task = 0, TaskContext.get().partitionId()
            for _, ids, at in documents_in((b.column(0) for b in batches), token_type(size)):
                places = places_of(at, turn, rounds)
                if len(places):
                    steps(mine, seen, tree, neighbours(ids, at, places, size.tokens), ids[places])
                    used += len(places)
            if used:
                change = flat(mine) - flat(start)
                weight = np.where(change != 0, np.float32(used), np.float32(0))
                parts = [[x.tobytes() for x in np.array_split(v, PARTS)] for v in (change * weight, weight)]
                yield pa.RecordBatch.from_pydict(
                    {"part": pa.array(range(PARTS), pa.int32()), "salt": pa.array([task // 64] * PARTS, pa.int32()),
                     "change": pa.array(parts[0], pa.binary()), "weight": pa.array(parts[1], pa.binary())}
                )

        kind = "part int, salt int, change binary, weight binary"
        sums = tokens.select(f"{CODED}.ids").coalesce(tasks).mapInArrow(local, kind).groupBy("part", "salt").applyInArrow(added, kind)
        means = stored(sums.groupBy("part").applyInArrow(added, kind), "network").orderBy("part").toArrow()
        if len(means):
            change, weight = (np.concatenate([np.frombuffer(x.as_py(), np.float32) for x in means[c]]) for c in ("change", "weight"))
            net = shaped(flat(start) + change / np.maximum(weight, 1), size)
    return net


def with_likelihood(docs: DataFrame, text: str = "text") -> DataFrame:
    """Add n_tokens (long), log_prob (their sum of conditional log-probabilities) and mean_log_prob to every row.

    The model is trained on the documents themselves. Whole texts count; a text without
    words (null, empty, blank) has 0 tokens, log_prob 0 and a null mean. Columns named like
    the added ones are replaced.
    """
    rows = own_names(docs, [*COLUMNS, CODED, ROW, "_of", "_within"])
    counts = stored(word_counts(rows, text), "word-counts")
    n_words = counts.agg(F.sum("n")).first()[0] or 0
    size = sizes(n_words)
    top = frequent_words(counts, size)
    tree = tree_of(token_counts(counts, top, size))
    tokens = stored(encoded(rows, text, top["word"].to_numpy().view(U), size).drop(text), "tokens")
    net = trained(tokens, size, tree, training_tasks(n_words, size))

    @F.arrow_udf("double")
    def scored(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for n, ids, at in documents_in(batches, token_type(size)):
            value = log_probs(net, tree, neighbours(ids, at, np.arange(len(ids)), size.tokens), ids) if len(ids) else np.zeros(0)
            total = np.concatenate([[0.0], np.cumsum(value)])
            yield pa.array(total[at[1:]] - total[at[:-1]], pa.float64())

    ids = F.col(f"{CODED}.ids")
    count = (F.octet_length(ids) / np.dtype(token_type(size)).itemsize).cast("long")
    counted = tokens.withColumns({"log_prob": scored(ids), "n_tokens": count}).drop(CODED)
    words = tokens.select(F.col(ROW).alias("_of"), F.explode(f"{CODED}.rest").alias("word"))
    within = words.join(shares(counts, top, size), "word").groupBy("_of").agg(F.sum("share").alias("_within"))
    whole = counted.join(within, F.col(ROW) == F.col("_of"), "left")
    whole = whole.withColumn("log_prob", F.col("log_prob") + F.coalesce("_within", F.lit(0.0))).drop(ROW, "_of", "_within")
    return whole.withColumn("mean_log_prob", F.when(F.col("n_tokens") > 0, F.col("log_prob") / F.col("n_tokens")))
