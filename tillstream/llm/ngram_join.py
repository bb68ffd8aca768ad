"""Documents whose sets of word 5-grams have a Jaccard similarity of 0.8 or more.

The order of all n-grams (by hash) is cut into fragments. Each fragment learns which of its
n-grams occur in several different sets, and how often. A document's set is then known by
its shared n-grams alone; where they are fewer than four fifths of it, nothing can link to
it. The others are joined on their rarest n-grams (prefix filter), and the overlap of a
candidate pair is counted fragment by fragment and summed.

Equal sets are one from the start. Candidates are first pairs with one leader per n-gram,
so that a large group of near copies becomes one component in linear work; afterwards all
remaining pairs between different components are compared, so that no link is lost.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillstream.llm.components import components, spread_join
from tillstream.llm.stage import stored
from tillstream.llm.text import U, blocks, mixed, shingle_sets, words_of

SIZE = 5
TOKEN_BITS = 40
FRAGMENT_TOKENS = 2 << 20
LEAST_FRAGMENT_BITS = 5
BLOCK_TOKENS = 2 << 20
HOT_SHARE, HOT_LEAST, HOT_LIMIT = 100, 8, 1 << 20
LEADER_ROUNDS = 2
VERTICALS = 8
SKETCH_WORDS = 32

SETS = "doc_id long, n_shingles long, d1 long, d2 long, hot array<long>, hot_n array<long>"
PARTS = "fragment int, keys binary, sizes binary, tokens binary"
SHARED = "bucket int, fragment int, keys binary, sizes binary, tokens binary, df binary"
MEMBERS = "key long, n int, prefix int, tokens array<long>, sketch array<long>"


def digests(hashes: np.ndarray, at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Two sums over each set's mixed n-grams: equal for equal sets."""
    out = []
    for k in (1, 2):
        total = np.concatenate([np.zeros(1, U), np.cumsum(mixed(hashes * U(2 * k + 1) + U(k)))])
        out.append((total[at[1:]] - total[at[:-1]]).view(np.int64))
    return out[0], out[1]


def runs_of(values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Different values of a sorted array and how often each stands there."""
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])[: len(values)])
    return values[first], np.diff(np.append(first, len(values)))


def gathered(batches: Iterator[pa.RecordBatch], column: str) -> Iterator[tuple[pa.RecordBatch, pa.Array]]:
    for batch in batches:
        row = 0
        for block in blocks(batch.column(column)):
            yield batch.slice(row, len(block)), block
            row += len(block)


def describe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Size and digests of every set; and the n-grams that are frequent among some thousand sets."""
    schema = pa.schema([("doc_id", pa.int64()), *[(c, pa.int64()) for c in ("n_shingles", "d1", "d2")], *[(c, pa.list_(pa.int64())) for c in ("hot", "hot_n")]])
    held, docs = [], 0

    def frequent() -> pa.RecordBatch:
        values, counts = runs_of(np.sort(np.concatenate(held)))
        often = counts >= max(HOT_LEAST, docs // HOT_SHARE)
        lists = [pa.array([x[often].view(np.int64) if x.dtype == U else x[often]], pa.list_(pa.int64())) for x in (values, counts)]
        return pa.RecordBatch.from_arrays([pa.nulls(1, pa.int64())] * 4 + lists, schema=schema)

    for batch, texts in gathered(batches, "text"):
        hashes, at = shingle_sets(words_of(texts), SIZE)
        d1, d2 = digests(hashes, at)
        none = pa.nulls(len(batch), pa.list_(pa.int64()))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(np.diff(at)), pa.array(d1), pa.array(d2), none, none], schema=schema)
        held.append(hashes)
        docs += len(batch)
        if sum(map(len, held)) >= BLOCK_TOKENS:
            yield frequent()
            held, docs = [], 0
    if docs:
        yield frequent()


def token_bytes(tokens: np.ndarray) -> bytes:
    """Five bytes for each 40-bit number."""
    return np.ascontiguousarray(tokens.astype("<u8").view(np.uint8).reshape(-1, 8)[:, : TOKEN_BITS // 8]).tobytes()


def token_numbers(data: bytes) -> np.ndarray:
    wide = np.zeros((len(data) * 8 // TOKEN_BITS, 8), np.uint8)
    wide[:, : TOKEN_BITS // 8] = np.frombuffer(data, np.uint8).reshape(-1, TOKEN_BITS // 8)
    return wide.view("<u8").ravel()


def cutter(bits: int, hot: np.ndarray):
    """Cut sets into fragments of the n-gram order. Frequent n-grams go to fragment -1 with the sets' sizes."""

    def parts(keys, at, hashes) -> Iterator[tuple]:
        owner = np.repeat(np.arange(len(keys)), np.diff(at))
        place = np.minimum(np.searchsorted(hot, hashes), max(len(hot) - 1, 0))
        is_hot = hot[place] == hashes if len(hot) else np.zeros(len(hashes), bool)
        counts = np.bincount(owner[is_hot], minlength=len(keys)).astype(np.uint32)
        sizes = np.stack([counts, np.diff(at).astype(np.uint32)], 1)
        yield -1 - int(keys[0] & 255), keys.tobytes(), sizes.tobytes(), token_bytes(place[is_hot].astype(U))
        owner, rest = owner[~is_hot], hashes[~is_hot]
        fragment = (rest >> U(64 - bits)).astype(np.int64)
        order = np.argsort(fragment, kind="stable")
        owner, rest, fragment = owner[order], rest[order], fragment[order]
        edges = np.flatnonzero(np.append(True, fragment[1:] != fragment[:-1])[: len(fragment)])
        for a, b in zip(edges, np.append(edges[1:], len(fragment))):
            who, count = runs_of(owner[a:b])
            tokens = (rest[a:b] << U(bits)) >> U(64 - TOKEN_BITS)
            yield int(fragment[a]), keys[who].tobytes(), count.astype(np.uint32).tobytes(), token_bytes(tokens)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}

        def flush() -> pa.RecordBatch:
            keys = np.fromiter(held, np.int64, len(held))
            at = np.concatenate([[0], np.cumsum([len(x) for x in held.values()])])
            rows = list(zip(*parts(keys, at, np.concatenate(list(held.values())))))
            return pa.RecordBatch.from_arrays([pa.array(rows[0], pa.int32()), *[pa.array(c, pa.binary()) for c in rows[1:]]], ["fragment", "keys", "sizes", "tokens"])

        total = 0
        for _, texts in gathered(batches, "text"):
            hashes, at = shingle_sets(words_of(texts), SIZE)
            for key, a, b in zip(digests(hashes, at)[0].tolist(), at[:-1].tolist(), at[1:].tolist()):
                if b > a and key not in held:
                    held[key] = hashes[a:b].copy()
                    total += b - a
            if total >= BLOCK_TOKENS:
                yield flush()
                held, total = {}, 0
        if held:
            yield flush()

    return cut


def sharer(buckets: int):
    """Within one fragment: which n-grams stand in several sets, for each set, dealt out by set."""

    def shared(group: pa.Table) -> pa.Table:
        fragment = group["fragment"][0].as_py()
        names = ["bucket", "fragment", "keys", "sizes", "tokens", "df"]
        if fragment < 0:
            out = []
            for keys, sizes, tokens in zip(*(group[c].to_pylist() for c in ("keys", "sizes", "tokens"))):
                out += dealt(np.frombuffer(keys, np.int64), np.frombuffer(sizes, np.uint32).reshape(-1, 2), token_numbers(tokens), None, buckets)
        else:
            keys = np.concatenate([np.frombuffer(x, np.int64) for x in group["keys"].to_pylist()])
            count = np.concatenate([np.frombuffer(x, np.uint32) for x in group["sizes"].to_pylist()]).astype(np.int64)
            tokens = np.concatenate([token_numbers(x) for x in group["tokens"].to_pylist()])
            _, first = np.unique(keys, return_index=True)  # of equal sets one counts
            once = np.zeros(len(keys), bool)
            once[first] = True
            tokens = tokens[np.repeat(once, count)]
            keys, count = keys[once], count[once]
            owner = np.repeat(np.arange(len(keys)), count)
            order = np.argsort(tokens, kind="stable")
            _, often = runs_of(tokens[order])
            df = np.empty(len(tokens), np.uint16)
            df[order] = np.repeat(np.minimum(often, 65535).astype(np.uint16), often)
            del order
            many = df > 1
            kept = np.bincount(owner[many], minlength=len(keys))
            has = kept > 0
            out = dealt(keys[has], kept[has].astype(np.uint32)[:, None], tokens[many], df[many], buckets)
        columns = list(zip(*[(b, fragment, *rest) for b, *rest in out])) or [[]] * 6
        kinds = [pa.int32(), pa.int32(), *[pa.binary()] * 4]
        return pa.Table.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    return shared


def dealt(keys: np.ndarray, sizes: np.ndarray, tokens: np.ndarray, df: np.ndarray | None, buckets: int) -> list[tuple]:
    """Rows for each bucket of sets; the first of a set's sizes is the number of its tokens here."""
    bucket = keys % buckets
    order = np.argsort(bucket, kind="stable")
    count = sizes[:, 0].astype(np.int64)
    start = np.cumsum(count) - count
    inner = np.cumsum(count[order]) - count[order]
    where = np.arange(count.sum()) - np.repeat(inner, count[order]) + np.repeat(start[order], count[order])
    keys, sizes, bucket = keys[order], sizes[order], bucket[order]
    ends = np.concatenate([[0], np.cumsum(count[order])])
    edges = np.flatnonzero(np.append(True, bucket[1:] != bucket[:-1])[: len(bucket)])
    out = []
    for a, b in zip(edges, np.append(edges[1:], len(bucket))):
        at = where[ends[a] : ends[b]]
        out.append((int(bucket[a]), keys[a:b].tobytes(), sizes[a:b].tobytes(), token_bytes(tokens[at]), b"" if df is None else df[at].tobytes()))
    return out


def members(group: pa.Table) -> pa.Table:
    """The sets of a bucket that share at least four fifths of their n-grams, rarest n-grams first.

    `prefix` is how many of the shared n-grams stand in the prefix of the whole set, whose
    first places belong to n-grams of no other set. `sketch` holds bits that each shared
    n-gram flips, so that two sets differ in at least as many n-grams as their sketches in bits.
    """
    keys, tokens, df, all_keys, all_n = [], [], [], [np.zeros(0, np.int64)], [np.zeros(0, np.int64)]
    for fragment, k, s, t, f in zip(*(group[c].to_pylist() for c in ("fragment", "keys", "sizes", "tokens", "df"))):
        k = np.frombuffer(k, np.int64)
        s = np.frombuffer(s, np.uint32).reshape(len(k), -1).astype(np.int64)
        if fragment < 0:
            all_keys.append(k)
            all_n.append(s[:, 1])
        keys.append(np.repeat(k, s[:, 0]))
        base = U(1 << 62) if fragment < 0 else U(fragment << TOKEN_BITS)
        tokens.append(token_numbers(t) | base)
        df.append(np.full(len(keys[-1]), 1 << 16) if fragment < 0 else np.frombuffer(f, np.uint16).astype(np.int64))
    known, first = np.unique(np.concatenate(all_keys), return_index=True)
    n = np.concatenate(all_n)[first]
    keys, tokens, df = np.concatenate(keys), np.concatenate(tokens), np.concatenate(df)
    order = np.lexsort((tokens, df, keys))
    keys, tokens = keys[order], tokens[order]
    new = np.append(True, (keys[1:] != keys[:-1]) | (tokens[1:] != tokens[:-1]))[: len(keys)]
    keys, tokens = keys[new], tokens[new]  # equal sets from different tasks
    start, stop = np.searchsorted(keys, known), np.searchsorted(keys, known, "right")
    least = (4 * n + 4) // 5
    prefix = n - least + 1 - (n - (stop - start))
    good = stop - start >= least
    known, n, prefix, start, stop = (x[good] for x in (known, n, prefix, start, stop))
    lists = [tokens[a:b].view(np.int64) for a, b in zip(start, stop)]
    bits = [sketched(tokens[a:b]) for a, b in zip(start, stop)]
    longs = pa.list_(pa.int64())
    columns = [pa.array(known), pa.array(n, pa.int32()), pa.array(prefix, pa.int32()), pa.array(lists, longs), pa.array(bits, longs)]
    return pa.Table.from_arrays(columns, ["key", "n", "prefix", "tokens", "sketch"])


def sketched(tokens: np.ndarray) -> np.ndarray:
    h = mixed(tokens)
    bit = (h % U(64 * SKETCH_WORDS)).astype(np.int64)
    odd = np.bincount(bit, minlength=64 * SKETCH_WORDS) % 2
    return np.packbits(odd.astype(np.uint8), bitorder="little").view(np.int64)


def fragment_bits(sets: DataFrame) -> int:
    """Fragments double with the n-grams, so that each holds about as many."""
    total = sets.agg(F.sum("n_shingles")).first()[0] or 0
    return max(LEAST_FRAGMENT_BITS, int(total // FRAGMENT_TOKENS).bit_length())


def sharing_sets(docs: DataFrame, sets: DataFrame, text: str = "text") -> DataFrame:
    """key, n, prefix, tokens of all different sets that may have a partner."""
    bits = fragment_bits(sets)
    documents = sets.where("hot is null").count()
    pairs = sets.where("hot is not null").select(F.explode(F.arrays_zip("hot", "hot_n")).alias("h"))
    often = pairs.groupBy(F.col("h.hot").alias("h")).agg(F.sum("h.hot_n").alias("n")).where(F.col("n") * HOT_SHARE >= documents)
    # At most HOT_SHARE times the mean size of a set pass the share; the limit bounds what is sent in any case.
    hot = np.sort(often.orderBy(F.col("n").desc(), "h").limit(HOT_LIMIT).select("h").toArrow()["h"].to_numpy().view(U))
    parts = docs.select(F.col(text).alias("text")).mapInArrow(cutter(bits, hot), PARTS)
    buckets = 1 << bits
    found = parts.groupBy("fragment").applyInArrow(sharer(buckets), SHARED)
    return stored(found.groupBy("bucket").applyInArrow(members, MEMBERS), "sharing-sets")


def verticals(sets: DataFrame, bits: int) -> DataFrame:
    """key, fragment, part: each set's shared n-grams cut at fixed places of the order; frequent ones come last."""
    def fragment(t):
        return F.when(t >= F.lit(1 << 62), VERTICALS).otherwise(F.shiftright(t, TOKEN_BITS + bits - 3)).cast("int")

    cut = F.transform(F.sequence(F.lit(0), F.lit(VERTICALS)), lambda f: F.filter("tokens", lambda t: fragment(t) == f))
    return sets.select("key", F.posexplode(cut).alias("fragment", "part")).where(F.size("part") > 0)


def linked(pairs: DataFrame, parts: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b, na, nb) that are similar enough: overlaps are counted in each fragment and summed."""
    right = parts.select(F.col("key").alias("b"), "fragment", F.col("part").alias("part_b"))
    left = parts.select(F.col("key").alias("a"), "fragment", F.col("part").alias("part_a"))
    met = pairs.join(right, "b").join(left, ["a", "fragment"])
    common = met.groupBy("a", "b", "na", "nb").agg(F.sum(F.size(F.array_intersect("part_a", "part_b"))).alias("common"))
    return common.where(F.col("common") * 100 >= percent * (F.col("na") + F.col("nb") - F.col("common"))).select("a", "b")


def near(n, m, percent: int):
    return (F.least(n, m) * 100) >= percent * F.greatest(n, m)


def joined(posts: DataFrame, roots: DataFrame | None) -> DataFrame:
    """The postings with the component of their set; without edges a set is its own."""
    if roots is None:
        return posts.withColumn("c", F.col("key"))
    found = posts.join(roots, posts["key"] == roots["node"], "left")
    return found.select(*posts.columns, F.coalesce("root", "key").alias("c"))


def leader_pairs(posts: DataFrame, turn: int, percent: int) -> DataFrame:
    """Pairs of a set with the leaders it meets, one under each n-gram, unless both are in one component already.

    In the first turn only the leader met most often: most sets need no other. There are
    never more pairs than n-grams in prefixes.
    """
    first = F.min(F.struct(F.xxhash64("key", F.lit(turn)), F.col("key").alias("a"), F.col("n").alias("na"), F.col("c").alias("ca")))
    lead = posts.groupBy("token").agg(first.alias("lead"), F.min("c").alias("low"), F.max("c").alias("high")).where("low < high")
    met = spread_join(posts, lead.select("token", "lead"), "token").where("key <> lead.a and c <> lead.ca")
    met = met.where(near(F.col("n"), F.col("lead.na"), percent))
    counted = met.groupBy("key", "n", F.col("lead.a").alias("a"), F.col("lead.na").alias("na")).agg(F.count(F.lit(1)).alias("times"))
    if turn:
        return counted.select("a", F.col("key").alias("b"), "na", F.col("n").alias("nb"))
    best = counted.groupBy("key", "n").agg(F.max(F.struct("times", "a", "na")).alias("best"))
    return best.select(F.col("best.a").alias("a"), F.col("key").alias("b"), F.col("best.na").alias("na"), F.col("n").alias("nb"))


def cross_pairs(posts: DataFrame, sketches: DataFrame, percent: int) -> DataFrame:
    """All pairs of sets of different components that meet under an n-gram of both prefixes and may reach the overlap.

    What may not: sizes too far apart, too few n-grams behind the one they meet under, or
    sketches and lone n-grams that differ in more places than similar sets can.

    Under each n-gram only the sets outside its largest component are joined with all, so
    that a large group that is one component costs nothing.
    """
    sizes = posts.groupBy("token", "c").agg(F.count(F.lit(1)).alias("times"))
    main = sizes.groupBy("token").agg(F.max(F.struct("times", "c"))["c"].alias("main"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    several = spread_join(posts, main.select("token", "main"), "token")
    several = several.join(sketches, "key")
    minor = several.where("c <> main").select(F.col("token").alias("t"), *[F.col(x).alias(f"{x}1") for x in ("key", "n", "place", "c", "alone", "sketch")])
    met = several.join(minor, F.col("token") == F.col("t")).where("c <> c1 and (c = main or key > key1)")
    left = F.least(F.col("n") - F.col("place"), F.col("n1") - F.col("place1"))
    # The n-gram counts as the first that both share, so what follows it bounds the overlap.
    met = met.where(near(F.col("n"), F.col("n1"), percent) & (left * (100 + percent) >= percent * (F.col("n") + F.col("n1"))))
    differ = F.col("alone") + F.col("alone1")
    for i in range(SKETCH_WORDS):
        differ = differ + F.bit_count(F.get("sketch", F.lit(i)).bitwiseXOR(F.get("sketch1", F.lit(i))))
    met = met.where(differ * (100 + percent) <= (100 - percent) * (F.col("n") + F.col("n1")))
    swap = F.col("key") > F.col("key1")
    return met.select(
        F.when(swap, F.col("key1")).otherwise(F.col("key")).alias("a"), F.when(swap, F.col("key")).otherwise(F.col("key1")).alias("b"),
        F.when(swap, F.col("n1")).otherwise(F.col("n")).alias("na"), F.when(swap, F.col("n")).otherwise(F.col("n1")).alias("nb"),
    ).distinct()


def classes(docs: DataFrame, text: str = "text") -> DataFrame:
    """doc_id, n_shingles and component_id of every row.

    component_id is the smallest id that is reachable over links. A text without words
    (null, empty, blank) links with nothing. Rows without an id get no component and
    don't name one; rows that repeat an id are listed as often as they stand there.
    """
    percent = 80
    plain = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col(text).alias("text"))
    sets = stored(plain.mapInArrow(describe, SETS), "sets")
    rows = sets.where("hot is null").select("doc_id", "n_shingles", "d1", "d2")
    shared = sharing_sets(plain, sets)
    posts = shared.select("key", "n", (F.col("n") - F.size("tokens")).alias("alone"), F.posexplode(F.slice("tokens", F.lit(1), F.col("prefix"))))
    sketches = shared.select("key", (F.col("n") - F.size("tokens")).alias("alone"), "sketch")
    posts = stored(posts.select("key", "n", (F.col("alone") + F.col("pos")).alias("place"), F.col("col").alias("token")), "postings")
    parts = verticals(shared, fragment_bits(sets))
    edges, roots = None, None
    for turn in range(LEADER_ROUNDS + 1):
        placed = joined(posts, roots)
        pairs = leader_pairs(placed, turn, percent) if turn < LEADER_ROUNDS else cross_pairs(placed, sketches, percent)
        found = stored(linked(pairs, parts, percent), "links")
        if turn < LEADER_ROUNDS and turn and found.isEmpty():
            continue
        edges = found if edges is None else edges.union(found)
        roots = components(edges)
    same = rows.where("n_shingles > 0 and doc_id is not null").groupBy("d1", "d2", "n_shingles").agg(F.min("doc_id").alias("first"))
    same = same.join(roots, same["d1"] == roots["node"], "left").select("d1", "d2", "n_shingles", "first", F.coalesce("root", "d1").alias("c"))
    named = spread_join(same, same.groupBy("c").agg(F.min("first").alias("component")), "c")
    named = named.select(F.xxhash64("d1", "d2", "n_shingles").alias("set"), *[F.col(x).alias(f"{x}_") for x in ("d1", "d2", "n_shingles")], "component")
    equal = (rows["d1"] == named["d1_"]) & (rows["d2"] == named["d2_"]) & (rows["n_shingles"] == named["n_shingles_"])
    out = rows.join(named, equal & (F.xxhash64(rows["d1"], rows["d2"], rows["n_shingles"]) == named["set"]), "left")
    known = F.when(F.col("doc_id").isNotNull(), F.coalesce("component", "doc_id"))
    return out.select("doc_id", "n_shingles", known.alias("component_id"))
