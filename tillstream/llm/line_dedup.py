"""Removal of repeated passages: content-defined chunks of lines, compared over all documents.

A rolling hash over two line hashes stands behind every line. A chunk ends where this
number is smaller than both neighbours, so that boundaries depend on the lines around them
only and come back after an insertion. A line of over 50 words is a chunk of its own.
Chunks of several lines and 20 words, and those single lines, are coarse pieces. Where a
passage begins or ends within a chunk, or is too short to hold one, the fine pieces do:
every two lines in a row, the span of one rolling hash.

A piece whose bytes stand in an earlier place (smaller id, then place) is repeated, and so
are its lines. Lines in a row that are repeated make a passage, which is cut out if it has
several lines and 20 words, or over 50 words. So no repeated passage of two or more such
lines stays, and of every cut line an earlier copy is left.

SQL functions only. Texts are shuffled twice, to fetch the repeated pieces for the
comparison of bytes and to put the remaining text together; all else moves hashes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tillstream.llm.quality_rules import WORD, bound
from tillstream.llm.stage import own_names, stored

MIN_LINES, MIN_WORDS, LONG_LINE = 2, 20, 50
FACTOR, MODULUS = 31, 2147483647
# Places from here on are those of windows, by their first line; chunks count from zero.
WINDOWS = 1 << 30
REMOVED_LINES, REMOVED_CHUNKS = "n_removed_lines", "n_removed_chunks"
KEY = ["doc_id", "text_hash"]


def line_hash(line: Column) -> Column:
    return F.conv(F.substring(F.md5(line.cast("binary")), 1, 12), 16, 10).cast("long")


def chunks_of(text: Column) -> Column:
    """Array of struct(text, n_lines, n_words, start) that spells the text, joined by line breaks; `start` counts lines."""

    def of_lines(lines: Column) -> Column:
        facts = F.transform(lines, lambda x: F.struct(line_hash(x).alias("h"), F.regexp_count(x, F.lit(WORD)).alias("w")))

        def of_facts(fact: Column) -> Column:
            def rolled(f: Column, i: Column) -> Column:
                before = F.coalesce(F.get(fact, i - 1)["h"], F.lit(0))
                return F.pmod(before * FACTOR + f["h"], F.lit(MODULUS))

            def of_rolling(r: Column) -> Column:
                def ends(i: Column) -> Column:
                    here, last = F.get(r, i), i == F.size(r) - 1
                    low = (here < F.coalesce(F.get(r, i - 1), F.lit(MODULUS))) & (here <= F.coalesce(F.get(r, i + 1), F.lit(MODULUS)))
                    long = (F.get(fact, i)["w"] > LONG_LINE) | (F.get(fact, i + 1)["w"] > LONG_LINE)
                    return last | low | long

                def of_ends(end: Column) -> Column:
                    def chunk(e: Column, k: Column) -> Column:
                        start = F.coalesce(F.get(end, k - 1) + 1, F.lit(0))
                        size = e - start + 1
                        words = F.aggregate(F.slice(fact, start + 1, size), F.lit(0).cast("long"), lambda a, f: a + f["w"])
                        return F.struct(
                            F.array_join(F.slice(lines, start + 1, size), "\n").alias("text"),
                            size.cast("long").alias("n_lines"),
                            words.alias("n_words"),
                            start.alias("start"),
                        )

                    return F.transform(end, chunk)

                return bound(F.filter(F.sequence(F.lit(0), F.size(r) - 1), ends), of_ends)

            return bound(F.transform(fact, rolled), of_rolling)

        return bound(facts, of_facts)

    return bound(F.split(text, "\n"), of_lines)


def removable(chunk: Column) -> Column:
    return ((chunk["n_lines"] >= MIN_LINES) & (chunk["n_words"] >= MIN_WORDS)) | (chunk["n_words"] > LONG_LINE)


def windows_of(text: Column) -> Column:
    """Array of every two lines in a row."""

    def of_lines(lines: Column) -> Column:
        pairs = F.transform(F.sequence(F.lit(0), F.size(lines) - 2), lambda i: F.concat(F.get(lines, i), F.lit("\n"), F.get(lines, i + 1)))
        return F.when(F.size(lines) > 1, pairs).otherwise(F.array().cast("array<string>"))

    return bound(F.split(text, "\n"), of_lines)


def pieces_of(text: Column) -> Column:
    """Array of struct(place, h) of all pieces that may be repeated; hashes of chunks and windows differ."""

    def placed(place: Column, h: Column) -> Column:
        return F.struct(place.cast("int").alias("place"), h.alias("h"))

    coarse = F.transform(chunks_of(text), lambda c, i: F.when(removable(c), placed(i, F.xxhash64(c["text"], F.lit(0)))))
    fine = F.transform(windows_of(text), lambda w, i: F.when(w.rlike(WORD), placed(i + WINDOWS, F.xxhash64(w, F.lit(1)))))
    return F.filter(F.concat(coarse, fine), lambda x: x.isNotNull())


def keyed(docs: DataFrame, text: str) -> DataFrame:
    """A document is known by its id and its text; rows that repeat both are one document."""
    return docs.withColumn("text_hash", F.xxhash64(F.coalesce(text, F.lit(""))))


def same_document(left: DataFrame, right: DataFrame) -> Column:
    return left["doc_id"].eqNullSafe(right["of_id"]) & (left["text_hash"] == right["of_hash"])


def repeated(docs: DataFrame, text: str = "text") -> DataFrame:
    """of_id, of_hash, places: which chunks and windows of a document stand in an earlier place."""
    base = keyed(docs.select("doc_id", text), text).where(F.col(text).isNotNull())
    seen = base.select(*KEY, F.inline(pieces_of(F.col(text)))).distinct()
    often = seen.groupBy("h").agg(F.min(F.struct(*KEY, "place")).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1")
    # The second key makes both sides shuffle for the join itself, so that a hot chunk can be split there.
    often = often.select(F.col("h").alias("of"), F.xxhash64("h").alias("spread"), "first")
    hit = seen.join(often, (F.col("h") == F.col("of")) & (F.xxhash64("h") == F.col("spread")))
    marks = hit.groupBy(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")).agg(
        F.collect_list(F.struct("place", "h", (F.struct(*KEY, "place").eqNullSafe(F.col("first"))).alias("is_first"))).alias("marks")
    )
    texts = base.select(*KEY, F.col(text).alias("whole"))
    cut = [chunks_of(F.col("whole")).alias("chunks"), windows_of(F.col("whole")).alias("windows")]
    found = texts.join(marks, same_document(texts, marks)).select(*KEY, "marks", *cut)

    def piece(m: Column) -> Column:
        return F.when(m["place"] >= WINDOWS, F.get("windows", m["place"] - WINDOWS)).otherwise(F.get("chunks", m["place"])["text"])

    pieces = stored(
        found.select(*KEY, F.explode(F.transform("marks", lambda m: F.struct(m.alias("m"), piece(m).alias("piece"))))).select(
            *KEY, "col.m.place", "col.m.h", "col.m.is_first", "col.piece"
        ),
        "repeated-pieces",
    )
    # Rows that repeat a document yield its pieces again.
    first = pieces.where("is_first").groupBy(F.col("h").alias("of")).agg(F.first("piece").alias("bytes"))
    others = pieces.where("not is_first")
    equal = others.join(first, (others["h"] == first["of"]) & (F.xxhash64(others["h"]) == F.xxhash64(first["of"])) & (others["piece"] == first["bytes"]))
    return equal.groupBy(F.col("doc_id").alias("of_id"), F.col("text_hash").alias("of_hash")).agg(F.collect_set("place").alias("places"))


def passages(text: Column, places: Column) -> Column:
    """Array of struct(first, last): the lines in a row that are repeated and enough to be cut out."""

    def of_chunks(chunks: Column) -> Column:
        def lines_at(p: Column) -> Column:
            chunk = F.get(chunks, p)
            return F.when(p >= WINDOWS, F.array(p - WINDOWS, p - WINDOWS + 1)).otherwise(
                F.sequence(chunk["start"], (chunk["start"] + chunk["n_lines"] - 1).cast("int"))
            )

        def of_lines(at: Column) -> Column:
            firsts = F.filter(at, lambda x, i: F.coalesce(F.get(at, i - 1) != x - 1, F.lit(True)))
            lasts = F.filter(at, lambda x, i: F.coalesce(F.get(at, i + 1) != x + 1, F.lit(True)))
            return F.zip_with(firsts, lasts, lambda a, b: F.struct(a.alias("first"), b.alias("last")))

        return bound(F.array_sort(F.array_distinct(F.flatten(F.transform(places, lines_at)))), of_lines)

    def of_words(words: Column) -> Column:
        def enough(run: Column) -> Column:
            size = run["last"] - run["first"] + 1
            total = F.aggregate(F.slice(words, run["first"] + 1, size), F.lit(0).cast("long"), lambda a, w: a + w)
            return ((size >= MIN_LINES) & (total >= MIN_WORDS)) | (total > LONG_LINE)

        return F.filter(bound(chunks_of(text), of_chunks), enough)

    return bound(F.transform(F.split(text, "\n"), lambda x: F.regexp_count(x, F.lit(WORD))), of_words)


def without_repeats(docs: DataFrame, text: str = "text") -> DataFrame:
    """The rows with repeated passages cut out of their text, and how many passages and lines that were.

    Every row stays, with an empty text if all of it was removed; texts without removals,
    null included, are as before. Adds `n_removed_chunks` (passages) and `n_removed_lines`,
    in place of columns named so; all others, whatever their names, come back as they were.
    """
    rows = own_names(docs, [REMOVED_CHUNKS, REMOVED_LINES])
    names = rows.columns
    inner = rows.select(*[F.col(f"`{c}`").alias(f"c{i}") for i, c in enumerate(names)])
    whole = F.col(f"c{names.index(text)}")
    inner = keyed(inner.withColumn("doc_id", F.col(f"c{names.index('doc_id')}")), f"c{names.index(text)}")
    cut = repeated(docs.select("doc_id", text), text)
    joined = inner.join(cut, same_document(inner, cut), "left")

    def rest(runs: Column) -> Column:
        def of_lines(lines: Column) -> Column:
            def between(k: Column) -> Column:
                begin = F.coalesce(F.get(runs, k - 1)["last"] + 1, F.lit(0))
                return F.slice(lines, begin + 1, F.coalesce(F.get(runs, k)["first"], F.size(lines)) - begin)

            return F.flatten(F.transform(F.sequence(F.lit(0), F.size(runs)), between))

        return F.struct(
            F.array_join(bound(F.split(whole, "\n"), of_lines), "\n").alias("text"),
            F.size(runs).cast("long").alias("passages"),
            F.aggregate(runs, F.lit(0).cast("long"), lambda a, r: a + r["last"] - r["first"] + 1).alias("lines"),
        )

    found = F.col("places").isNotNull()
    done = joined.withColumn("rest", F.when(found, bound(passages(whole, F.col("places")), rest)))
    kept = [(F.when(found, F.col("rest.text")).otherwise(F.col(f"c{i}")) if c == text else F.col(f"c{i}")).alias(c) for i, c in enumerate(names)]
    zero = F.lit(0).cast("long")
    return done.select(
        *kept, F.coalesce("rest.passages", zero).alias(REMOVED_CHUNKS), F.coalesce("rest.lines", zero).alias(REMOVED_LINES)
    )
