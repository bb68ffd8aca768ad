import re
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

import corpus_pipeline
from tests.llm.shared import SF, WORD, awkward, documents, near_classes, prose
from tillstream.llm import components, decontaminate, line_dedup, ngram_join, quality_rules, registry

# Line dedup


def cut(spark, rows, **more):
    docs = documents(spark, rows).selectExpr("*", "1 as places", "'p' as of_id", "2 as N_REMOVED_LINES", "3 as c1", "4 as rest")
    return line_dedup.without_repeats(docs).collect()


def passage(seed, lines, words=12):
    return [" ".join(prose(f"{seed}{i}", words)) for i in range(lines)]


def test_a_repeated_passage_stays_in_one_document(spark):
    shared = passage("shared", 30)
    rows = [(i, "\n".join([*passage(f"a{i}", 3), *shared, *passage(f"b{i}", 4)])) for i in range(6)]
    got = sorted(cut(spark, rows))
    assert got[0].text == rows[0][1] and got[0].n_removed_chunks == 0
    for i, row in enumerate(got[1:], 1):
        assert row.text.split("\n") == [*passage(f"a{i}", 3), *passage(f"b{i}", 4)]
        assert (row.n_removed_chunks, row.n_removed_lines) == (1, 30)


def test_a_long_line_is_removed_and_short_ones_stay(spark):
    long, short = " ".join(prose("long", 51)), " ".join(prose("short", 10))
    got = {r.doc_id: r.text for r in cut(spark, [(1, f"{short}\none\n{long}"), (2, f"two\n{long}\n{short}"), (3, long)])}
    assert got == {1: f"{short}\none\n{long}", 2: f"two\n{short}", 3: ""}


def test_awkward_lines(spark):
    rows = [*awkward(), (20, "\n" * 500), (21, "\n" * 500), (None, None)]
    got = cut(spark, rows)
    assert len(got) == len(rows)
    texts = sorted((repr(r.doc_id), repr(r.text)) for r in got)
    base = awkward()[0][1]
    # A null id is the smallest; rows that repeat id and text are one document.
    expected = [(i, "" if t == base and i is not None else t) for i, t in rows]
    assert texts == sorted((repr(i), repr(t)) for i, t in expected)
    assert cut(spark, []) == []


@pytest.mark.parametrize("lines", [2, 3, 4, 7])
def test_no_short_passage_stays(spark, lines):
    """Whatever stands around it, and however few lines it has."""
    rows = []
    for n in range(12):
        shared = passage(f"p{n}", lines, 60 // lines)
        rows += [(100 * n + i, "\n".join([*passage(f"a{n}.{i}", i % 3), *shared, *passage(f"b{n}.{i}", (i + 1) % 3)])) for i in range(4)]
    for row in cut(spark, rows):
        n, i = divmod(row.doc_id, 100)
        wanted = [*passage(f"a{n}.{i}", i % 3), *(passage(f"p{n}", lines, 60 // lines) if i == 0 else []), *passage(f"b{n}.{i}", (i + 1) % 3)]
        assert row.text == "\n".join(wanted)


def repeats_by_hand(texts):
    """The rule on plain lists: lines of later windows of two lines, and long lines that stood before, in runs of enough words."""
    docs = {i: (t or "").split("\n") for i, t in texts}
    first, left = {}, {}
    for i in sorted(docs):
        lines, again = docs[i], set()
        for k in range(len(lines)):
            pair = tuple(lines[k : k + 2])
            if len(pair) == 2 and any(WORD.search(x) for x in pair) and first.setdefault(pair, (i, k)) != (i, k):
                again |= {k, k + 1}
            if len(WORD.findall(lines[k])) > 50 and first.setdefault(lines[k], (i, k)) != (i, k):
                again.add(k)
        runs, kept = [], list(lines)
        for k in sorted(again):
            if runs and runs[-1][-1] == k - 1:
                runs[-1].append(k)
            else:
                runs.append([k])
        for run in runs:
            n = sum(len(WORD.findall(lines[k])) for k in run)
            if (len(run) >= 2 and n >= 20) or n > 50:
                for k in run:
                    kept[k] = None
        left[i] = "\n".join(x for x in kept if x is not None)
    return left


def test_passages_equal_those_found_by_hand(spark):
    """Chunks hold nothing that the windows within them don't hold, so that windows and long lines decide."""
    draw = np.random.default_rng(12)
    known = [" ".join(prose(f"k{i}", int(draw.integers(1, 16)))) for i in range(25)] + ["", " ", " ".join(prose("long", 55))]
    texts = [(i, "\n".join(known[k] for k in draw.integers(0, len(known), draw.integers(0, 14)))) for i in range(60)]
    texts += [(100, "\n".join([known[0], known[1]] * 9)), (101, "\n".join([known[2]] * 12)), (102, None)]
    got = {r.doc_id: r.text for r in cut(spark, texts)}
    assert {i: t or "" for i, t in got.items()} == repeats_by_hand(texts)


def test_chunks_spell_the_text(spark):
    text = "\n".join(passage("x", 40, 5))
    chunks = documents(spark, [(1, text)]).select(line_dedup.chunks_of(line_dedup.F.col("text"))).first()[0]
    assert "\n".join(c.text for c in chunks) == text and 8 <= len(chunks) <= 20
    assert sum(c.n_lines for c in chunks) == 40 and sum(c.n_words for c in chunks) == 200


# N-gram join


def test_classes_equal_brute_force(spark):
    base = prose("near", 120)
    rows = [(i, " ".join(base[: 100 + i % 7] + prose(f"tail{i}", i % 9))) for i in range(60)]
    rows += [(100 + i, " ".join(base[i : 100 + i])) for i in range(0, 20, 4)]
    rows += [(200 + i, " ".join(prose("boiler", 40) + prose(f"own{i}", 9 + i % 3))) for i in range(30)]
    docs = dict(rows)
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.classes(documents(spark, rows)).collect()}
    assert got == near_classes(docs)


def test_frequent_ngrams_and_small_fragments(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HOT_SHARE", 4)
    monkeypatch.setattr(ngram_join, "LEADER_ROUNDS", 0)
    rows = [(i, " ".join(prose("all", 50) + prose(f"g{i // 3}", 8) + prose(f"o{i}", 2))) for i in range(30)]
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in ngram_join.classes(documents(spark, rows)).collect()}
    assert got == near_classes(dict(rows))


def test_classes_of_given_documents(spark):
    docs = {r.doc_id: r.text for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in registry.op7_ngram_join(spark, SF).collect()}
    assert got == near_classes(docs)


def test_classes_of_awkward_rows(spark):
    rows = awkward()
    got = ngram_join.classes(documents(spark, rows).selectExpr("*", "1 as token", "2 as key")).collect()
    assert len(got) == len(rows)
    known = near_classes({i: t for i, t in rows if i is not None})
    for r in got:
        assert r.component_id is None if r.doc_id is None else (r.n_shingles, r.component_id) == known[r.doc_id]
    assert ngram_join.classes(documents(spark, [])).count() == 0


def test_components_of_paths_and_stars(spark):
    edges = [(i, i + 1) for i in range(40)] + [(100, 100 + i) for i in range(1, 30)] + [(7, 7), (300, 200), (200, 300)]
    got = dict(map(tuple, components.components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert got == {i: 0 for i in range(41)} | {i: 100 for i in range(100, 130)} | {200: 200, 300: 200}


# Decontamination


def plain_alignment(item, words):
    """Best local alignment by the textbook recurrence."""
    h = np.zeros((len(item) + 1, len(words) + 1), int)
    for i, a in enumerate(item, 1):
        for j, b in enumerate(words, 1):
            same = decontaminate.MATCH if a == b else decontaminate.MISMATCH
            h[i, j] = max(0, h[i - 1, j - 1] + same, h[i - 1, j] + decontaminate.GAP, h[i, j - 1] + decontaminate.GAP)
    return h.max()


def test_alignment_equals_the_recurrence():
    draw = np.random.default_rng(3)
    for _ in range(60):
        item = draw.integers(1, 5, draw.integers(1, 12)).astype(np.uint64)
        windows = draw.integers(0, 5, (4, 15)).astype(np.uint64)
        best, low, high = decontaminate.aligned(item, windows)
        for row, value, a, b in zip(windows, best, low, high):
            assert value == plain_alignment(item, row)
            if value:
                assert plain_alignment(item, row[a : b + 1]) == value


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def test_exact_and_edited_items_are_found_and_clean_documents_are_not(spark):
    items = [(i, " ".join(prose(f"item{i}", 30))) for i in range(5)] + [(9, "a b"), (10, None), (11, " "), (None, "x")]
    exact = items[0][1]
    edited = items[1][1].split()
    edited[10], edited[20] = "changed", "also"
    del edited[15]
    filler = [" ".join(prose(f"doc{i}", 200)) for i in range(20)]
    rows = [(i, t) for i, t in enumerate(filler)]
    rows += [(100, f"{filler[0]} {exact.upper()} {filler[1]}"), (101, f"{filler[2]} {' '.join(edited)}"), (102, " ".join(items[2][1].split()[:6])), (103, "A B"), (104, None), (105, "")]
    rows += [(200 + i, items[3][1]) for i in range(40)]  # everywhere, so that no seed is rare
    got = decontaminate.leaks(documents(spark, rows), benchmark(spark, items)).toPandas().set_index(["doc_id", "item_id"])
    assert set(got.index) == {(100, 0), (101, 1), (103, 9), *((200 + i, 3) for i in range(40))}
    assert got.score[100, 0] == 1 and (got.first_word[100, 0], got.last_word[100, 0]) == (200, 229)
    assert 0.8 < got.score[101, 1] < 1
    assert decontaminate.leaks(documents(spark, []), benchmark(spark, items)).count() == 0
    assert decontaminate.leaks(documents(spark, rows), benchmark(spark, [])).count() == 0


def test_edited_copies_of_a_frequent_item_are_found(spark):
    item = prose("hot", 38)
    head, tail = list(item), list(item)
    for k in (2, 5, 8, 11):
        head[k] = f"changed{k}"  # no run of four words is left at the begin
    for k in range(14, 38, 4):
        tail[k] = f"changed{k}"
    rows = [(i, " ".join(item)) for i in range(60)]
    rows += [(100, " ".join([*prose("before", 50), *head, *prose("after", 50)])), (101, " ".join(tail)), (102, " ".join(item[20:24]))]
    got = decontaminate.leaks(documents(spark, rows), benchmark(spark, [(1, " ".join(item))])).toPandas().set_index("doc_id")
    assert set(got.index) == {*range(60), 100, 101}
    assert got.score[100] == pytest.approx((2 * 34 - 4) / 76) and got.first_word[100] == 50


def test_short_items_are_found_within_longer_documents(spark):
    items = [(1, "a b"), (2, "one"), (3, "x y z"), (4, " ".join(prose("long", 20)))]
    rows = [(1, "p q A b r s t u"), (2, "b a"), (3, "x y"), (4, "z one x y z"), (5, "one"), (6, None), (7, "y x z"), (8, items[3][1])]
    got = {(r.doc_id, r.item_id): (r.score, r.first_word, r.last_word) for r in decontaminate.leaks(documents(spark, rows), benchmark(spark, items)).collect()}
    assert got == {(1, 1): (1, 2, 3), (4, 2): (1, 1, 1), (4, 3): (1, 2, 4), (5, 2): (1, 0, 0), (8, 4): (1, 0, 19)}


def test_hits_in_small_parts_give_the_same_alignments(monkeypatch):
    items = decontaminate.items_of(np.arange(3), pa.array([" ".join(prose("same", 10) + prose(f"i{i}", 10)) for i in range(3)]))
    texts = pa.array([" ".join(prose("x", 9) + prose("same", 10) + prose(f"i{i}", 10)) for i in range(3)])
    whole = decontaminate.leaks_in(texts, items)
    monkeypatch.setattr(decontaminate, "HITS", 2)
    assert len(whole) == 9 and decontaminate.leaks_in(texts, items) == whole


def edited_copy(draw, words, share, block):
    """A copy with some words replaced, and perhaps a block of other words inserted."""
    copy = [f"new{draw.integers(10**6)}" if draw.random() < share else w for w in words]
    if block:
        at = int(draw.integers(len(copy) // 4, 3 * len(copy) // 4 + 1))
        copy[at:at] = [f"in{draw.integers(10**6)}" for _ in range(int(draw.integers(1, len(words))))]
    return copy


def test_edited_copies_score_as_aligned_with_the_whole_document(spark):
    """Recall and scores against brute force: replaced words, inserted blocks, both."""
    draw = np.random.default_rng(8)
    items, rows, wanted = [], [], {}
    for i in range(160):
        words = prose(f"b{i}", int(draw.integers(15, 60)))
        share, block = [(0.1, False), (0.25, False), (0.0, True), (0.1, True)][i % 4]
        doc = [*prose(f"before{i}", 40), *edited_copy(draw, words, share, block), *prose(f"after{i}", 40)]
        items.append((i, " ".join(words)))
        rows.append((1000 + i, " ".join(doc)))
        number = {w: n for n, w in enumerate({*words, *doc}, 1)}
        score = plain_alignment([number[w] for w in words], [number[w] for w in doc]) / (decontaminate.MATCH * len(words))
        seeds = {tuple(words[k : k + 4]) for k in range(len(words) - 3)}
        if score >= decontaminate.THRESHOLD and any(tuple(doc[k : k + 4]) in seeds for k in range(len(doc) - 3)):
            wanted[1000 + i, i] = score
    got = {(r.doc_id, r.item_id): r.score for r in decontaminate.leaks(documents(spark, rows), benchmark(spark, items)).collect()}
    assert len(wanted) > 130 and got == pytest.approx(wanted)


def test_a_stock_opening_of_many_items_costs_little():
    """Every document shares its words with every item, and holds none of them."""
    import time

    items = pa.array([f"what is the name of the {' '.join(prose(f's{i}', 12))}" for i in range(8000)])
    texts = pa.array([" ".join([*prose(f"t{i}", 30), "what is the name of the", *prose(f"u{i}", 30)]) for i in range(25)])
    known = decontaminate.items_of(np.arange(8000), items)
    began = time.time()
    assert decontaminate.leaks_in(texts, known) == {}
    assert time.time() - began < 20


def test_words_are_counted_in_parts(monkeypatch):
    items = decontaminate.items_of(np.arange(3), pa.array([" ".join(prose("same", 10) + prose(f"i{i}", 10)) for i in range(3)]))
    texts = pa.array([" ".join(prose("x", 9) + prose("same", 10) + prose(f"i{i}", 10)) for i in range(3)] + ["", "a"])
    whole = decontaminate.leaks_in(texts, items)
    monkeypatch.setattr(decontaminate, "COUNTED_WORDS", 1)
    assert decontaminate.leaks_in(texts, items) == whole


def test_large_benchmarks_come_in_blocks(spark, monkeypatch):
    items = [(i, " ".join(prose(f"item{i}", 20))) for i in range(9)]
    rows = [(i, t) for i, t in items]
    whole = decontaminate.leaks(documents(spark, rows), benchmark(spark, items)).toPandas()
    monkeypatch.setattr(decontaminate, "SHARD_WORDS", 50)
    parts = decontaminate.leaks(documents(spark, rows), benchmark(spark, items)).toPandas()
    order = ["doc_id", "item_id"]
    assert whole.sort_values(order).to_numpy().tolist() == parts.sort_values(order).to_numpy().tolist()


def test_all_verbatim_items_are_found_in_the_given_documents(spark):
    plain = lambda t: f" {' '.join(re.sub('[A-Z]', lambda m: m[0].lower(), t).split())} "
    items = [(r.item_id, plain(r.text)) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    holds = {(r.doc_id, i) for r in spark.read.parquet(f"{SF}/documents.parquet").collect() for i, t in items if t in plain(r.text)}
    got = {(r.doc_id, r.item_id) for r in registry.op1_decontaminate(spark, SF).collect()}
    assert holds and holds <= got


# Quality rules


def plain_statistics(text):
    text = text or ""
    words = WORD.findall(text)
    windows = list(zip(words, words[1:], words[2:]))
    often = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [x for x in text.split("\n") if WORD.search(x)]
    return len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text), len(lines) - len(set(lines)), len(covered)


@pytest.mark.parametrize("rows", [awkward(), [(1, "a b a b a b"), (2, "x x x x"), (3, "p q r\np q r\n\n\np q r s"), (4, "a b c \x01 a b c")], []])
def test_statistics(spark, rows):
    docs = documents(spark, rows).selectExpr("*", "1 as w", "2 as stratum", "3 as _text")
    got = quality_rules.with_statistics(docs).collect()
    told = sorted(repr((r.doc_id, (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words))) for r in got)
    assert told == sorted(repr((i, plain_statistics(t))) for i, t in rows)


def test_binomial_tail(spark):
    from math import comb

    rows = [(50, 0), (50, 3), (200, 7), (1, 0), (1, 1), (5000, 20)]
    frame = spark.createDataFrame(rows, "n long, k long").select("n", "k", quality_rules.at_most(quality_rules.F.col("n"), quality_rules.F.col("k"), 0.01).alias("p"))
    for r in frame.collect():
        assert r.p == pytest.approx(sum(comb(r.n, i) * 0.01**i * 0.99 ** (r.n - i) for i in range(r.k + 1)), rel=1e-9)


def test_cutoffs_limit_false_rejections(spark):
    good = " ".join(prose("good", 60))
    loud = " ".join(w.upper() + "!" for w in prose("loud", 60))
    rows = [(i, good + f" {i}") for i in range(6000)] + [(10_000 + i, loud + f" {i}") for i in range(50)]
    docs = documents(spark, rows)
    known = spark.createDataFrame([(i, 1, 0) for i in range(6000)] + [(10_000, 0, 0), (None, 1, 0)], "doc_id long, quality int, toxic int")
    kept = {r.doc_id: r.kept for r in quality_rules.judged(docs, known).collect()}
    assert all(kept[i] for i in range(6000)) and not any(kept[10_000 + i] for i in range(50))
    few = known.where("doc_id < 100")  # too few labels to promise anything
    assert all(r.kept for r in quality_rules.judged(docs, few).collect())
    mixed = known.union(spark.createDataFrame([(10_001 + i, 1, 0) for i in range(40)], known.schema))  # 40 of 6,040 good ones are loud: within the risk
    kept = {r.doc_id: r.kept for r in quality_rules.judged(docs, mixed).collect()}
    assert not any(kept[10_001 + i] for i in range(40))
    more = known.where("doc_id < 2000").union(spark.createDataFrame([(10_001 + i, 1, 0) for i in range(49)], known.schema))  # 49 of 2,049: not within it
    assert all(r.kept for r in quality_rules.judged(docs, more).collect() if r.doc_id != 10_000 or r.kept)
    assert sum(r.kept for r in quality_rules.judged(docs, more).collect()) == 6050


def test_small_and_unlabelled_strata_get_no_cutoff(spark):
    loud = " ".join(w.upper() + "!" for w in prose("loud", 60))
    langs = "case when doc_id < 300 then 'en' when doc_id < 400 then 'fr' when doc_id < 500 then null else 'es' end as lang"
    rows = [(i, " ".join(prose(i, 60))) for i in range(500)] + [(j, loud) for j in (150, 350, 450, 600)]
    docs = documents(spark, rows).selectExpr("doc_id", "text", langs, "1 as kept", "2 as stratum", "3 as n_words")
    known = docs.where("doc_id <> 150").select("doc_id").distinct().selectExpr("doc_id", "1 as quality")
    limits = quality_rules.cutoffs(quality_rules.with_statistics(docs), known)
    # 299 may share the level with another one of their size, 100 with none.
    assert [(r.stratum, r.n) for r in limits.collect()] == [("en", 299)]
    kept = [(r.doc_id, r.kept) for r in quality_rules.judged(docs, known).collect()]
    assert [i for i, k in kept if not k] == [150]
    assert quality_rules.judged(docs, known.limit(0)).where("not kept").count() == 0
    assert quality_rules.judged(docs.limit(0), known).count() == 0


@pytest.mark.parametrize(("sizes", "least", "m"), [([148], None, None), ([149], 149, 1), ([214, 47, 36], 214, 1), ([184, 183, 100], 183, 2), ([217, 217, 216, 217], 217, 3), ([217] * 4, 217, 4), ([10**6] * 3, 10**6, 3)])
def test_strata_are_chosen_by_size(spark, sizes, least, m):
    counts = spark.createDataFrame([(str(i), n) for i, n in enumerate(sizes)], "stratum string, n long")
    got = [tuple(r) for r in quality_rules.tested_sizes(counts, 0.02, 0.05).collect()]
    assert got == ([(least, m)] if m else [])


def test_the_risk_is_kept(spark):
    """400 strata whose good documents fail the loosest step a little more often than allowed: each is accepted in 5 % of cases at most."""
    strata, n = 400, 400
    rows = spark.range(strata * n).selectExpr("id as doc_id", "cast(id % 400 as string) as stratum", "pmod(xxhash64(id, 7), 1000) < 21 as bad")
    zero = {c: "0L" for c in ("word_chars", "n_dup_lines", "n_repeat_words", "n_upper", "n_exclamations")}
    statistics = rows.selectExpr("doc_id", "stratum", "100L as n_words", "if(bad, 900L, 0L) as n_symbols", "1L as n_lines", "false as base_failed", *[f"{v} as {c}" for c, v in zero.items()])
    accepted = quality_rules.cutoffs(statistics, rows.selectExpr("doc_id", "1 as quality"), level=0.05 * strata)
    assert 0 < accepted.count() <= 0.05 * strata + 3 * (0.05 * 0.95 * strata) ** 0.5


# Pipeline


def test_pipeline_stages_take_effect(spark):
    seen = {r.doc_id: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    out = corpus_pipeline.run(spark, SF).collect()
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality_classifier", "line_dedup", "ngram_join", "decontamination", "bpe_codec"]
    assert 50 < len(out) < len(seen) and len({r.doc_id for r in out}) == len(out)
    assert all(set(r.text.split("\n")) <= set(seen[r.doc_id].text.split("\n")) for r in out)
    left = {r.doc_id: r.text for r in out}
    assert all(i == c for i, (_, c) in near_classes(left).items())
    assert all(len(r.text) == r.n_chars for r in out if r.text != seen[r.doc_id].text)


def test_stages_pass_awkward_rows(spark, tmp_path):
    docs = documents(spark, awkward())
    spark.createDataFrame([(1, " ".join(prose("base", 60)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    spark.createDataFrame([(1, 1, 0)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, str(tmp_path)).columns == docs.columns
        assert stage(spark, documents(spark, []), str(tmp_path)).count() == 0
    assert "token_ids" in corpus_pipeline.STAGES[-1][1](spark, docs, str(tmp_path)).columns
    near = {r.doc_id for r in corpus_pipeline.join_near(spark, docs, str(tmp_path)).collect()}
    assert near == {1, 4, 5, 6, 7, 9, 10, None}
    clean = [r.doc_id for r in corpus_pipeline.decontaminated(spark, docs, str(tmp_path)).collect()]
    # The row without an id and with the item's text is found too; that without a text stays.
    assert sorted(clean, key=repr) == [10, 11, 4, 5, 6, 7, 9, None]


def test_only_what_was_found_goes(spark, tmp_path):
    """Two texts under one id, copies and leaks without an id."""
    a, b, c = (" ".join(prose(x, 40)) for x in "abc")
    spark.createDataFrame([(1, " ".join(prose("c", 40)))], "item_id long, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    docs = documents(spark, [(1, a), (2, a), (2, b), (2, b), (None, b), (None, a), (3, c), (3, "clean text"), (None, c), (None, None), (4, None)])
    docs = docs.withColumnRenamed("source", "document")
    near = corpus_pipeline.join_near(spark, docs, str(tmp_path))
    told = sorted(((r.doc_id, r.text) for r in near.collect()), key=repr)
    assert near.columns == docs.columns
    assert told == sorted([(1, a), (2, b), (2, b), (3, c), (3, "clean text"), (None, None), (4, None)], key=repr)
    clean = corpus_pipeline.decontaminated(spark, docs, str(tmp_path))
    assert clean.columns == docs.columns
    assert sorted(((r.doc_id, r.text) for r in clean.collect()), key=repr) == sorted(
        [(1, a), (2, a), (2, b), (2, b), (None, b), (None, a), (3, "clean text"), (None, None), (4, None)], key=repr
    )


def test_hashes_of_shingles_are_sets():
    from tillstream.llm.text import shingle_sets, words_of

    hashes, at = shingle_sets(words_of(pa.array(["a b c d e a b c d e", "a b", "", None, "A B"])))
    assert np.diff(at).tolist() == [5, 1, 0, 0, 1] and hashes[at[1]] == hashes[at[4]]
