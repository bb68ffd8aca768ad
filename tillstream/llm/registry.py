"""The operators of this package as named queries over the given tables, and their SQL."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tillstream.llm import (
    bpe_codec, decontaminate, line_dedup, lm_score, ngram_join, piece_counts, quality_fm, quality_rules, resampling, token_alignment, toxicity,
    url_filters, warc,
)
from tillstream.llm.samples import fold
from tillstream.llm.stage import table, whole_text
from tillstream.sources.settings import fresh_folder

WORD_VOCABULARY = "word_bpe_49k.json"
PIECE_MODEL = "piece_bpe_32k.model"
BYTE_VOCABULARY = "byte_bpe_50k.json"
TOKEN_LIMIT = 4096
# Verdict, host and path of the rules for URLs.
URL_RULES = [
    url_filters.Rule("allow", "com", "/"),
    url_filters.Rule("block", "example.com", "/en/"),
    url_filters.Rule("allow", "www.example.com", "/en/"),
    url_filters.Rule("block", "net", "/es/"),
    url_filters.Rule("block", "net", "/fr/"),
]


def sha256_of_ids(ids: Column) -> Column:
    return F.sha2(F.array_join(ids, " ").cast("binary"), 256)


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.leaks(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return lm_score.with_likelihood(docs).select("doc_id", *lm_score.COLUMNS)


def op3_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return line_dedup.without_repeats(docs).select(
        "doc_id",
        line_dedup.REMOVED_CHUNKS,
        line_dedup.REMOVED_LINES,
        F.length(whole_text()).cast("long").alias("n_chars_left"),
        F.sha2(whole_text().cast("binary"), 256).alias("left_sha256"),
    )


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.fit(docs, table(spark, sf_dir, "labels"))
    return judged(toxicity.with_scores(docs, model), fold("doc_id", toxicity.FOLDS) == toxicity.HELD_OUT)


def op6_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    model = quality_fm.fit(docs, table(spark, sf_dir, "labels"))
    return judged(quality_fm.with_scores(docs, model), fold("doc_id", quality_fm.FOLDS) == quality_fm.HELD_OUT)


def judged(scored: DataFrame, held_out: Column) -> DataFrame:
    predicted = F.when(F.col("score") >= 0.5, 1).otherwise(0)
    # A row without an id is in no fold.
    return scored.select("doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score", predicted.alias("predicted"))


def op5_bpe_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    coded = bpe_codec.with_tokens(docs, public_tokenizers.path(WORD_VOCABULARY))
    return coded.select(
        "doc_id",
        F.size(bpe_codec.IDS).cast("long").alias("n_tokens"),
        sha256_of_ids(F.col(bpe_codec.IDS)).alias("ids_sha256"),
        F.sha2(F.col(bpe_codec.DECODED).cast("binary"), 256).alias("decoded_sha256"),
    )


def op7_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.classes(table(spark, sf_dir, "documents").select("doc_id", "text"))


def op8_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    counted = piece_counts.with_counts(docs, public_tokenizers.path(PIECE_MODEL))
    return counted.select(
        "doc_id",
        F.octet_length(whole_text()).cast("long").alias("n_bytes"),
        piece_counts.COUNT,
        (F.col(piece_counts.COUNT) > TOKEN_LIMIT).alias("over_limit"),
    )


def op9_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    plan = warc.planned(table(spark, sf_dir, "pages"))
    archives = warc.write_archives(plan, fresh_folder(spark, "warc"))
    spread = archives.repartition(spark.sparkContext.defaultParallelism)
    return warc.read_archives(spread, payload=False).select(
        "page_id", "payload_bytes", "payload_digest", "record_type", "refers_to"
    )


def op10_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return quality_rules.judged(docs, table(spark, sf_dir, "labels")).select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "kept"
    )


def op11_token_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    a, b = public_tokenizers.path(BYTE_VOCABULARY), public_tokenizers.path(PIECE_MODEL)
    aligned = token_alignment.with_links(docs, a, b, keep=["doc_id"], digest=True)
    return aligned.select(F.col("doc_id").cast("long").alias("doc_id"), *token_alignment.COLUMNS[:-1], F.col("groups").alias("groups_sha256"))


def op12_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    drawn = resampling.resampled(docs, table(spark, sf_dir, "benchmark"), keep=["doc_id"])
    return drawn.select("doc_id", "n_features", "weight", "score", "rank")


def op13_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    listed = url_filters.urls_of_blocked_hosts(pages, URL_RULES)
    return url_filters.with_verdicts(pages, listed, URL_RULES).select("page_id", *url_filters.COLUMNS)


QUERIES = {
    "op1_decontaminate": op1_decontaminate,
    "op2_lm_score": op2_lm_score,
    "op3_line_dedup": op3_line_dedup,
    "op4_toxicity": op4_toxicity,
    "op5_bpe_codec": op5_bpe_codec,
    "op6_quality_classifier": op6_quality_classifier,
    "op7_ngram_join": op7_ngram_join,
    "op8_token_counts": op8_token_counts,
    "op9_warc": op9_warc,
    "op10_quality_rules": op10_quality_rules,
    "op11_token_alignment": op11_token_alignment,
    "op12_resampling": op12_resampling,
    "op13_url_filters": op13_url_filters,
}

BASE32 = " || ".join(
    "substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', "
    f"((('0x' || substr(digest, {5 * i + 1}, 5))::bigint >> {15 - 5 * k}) & 31)::int + 1, 1)"
    for i in range(8)
    for k in range(4)
)

STEP_FAILS = ", ".join(
    "(" + " or ".join(f"coalesce({statistic} > {quality_rules.cut_at(rule, i)}, false)" for rule, (statistic, _) in quality_rules.RULES.items()) + f") as x{i}"
    for i in range(quality_rules.STEPS)
)
STEP_COUNTS = " union all ".join(f"select stratum, {i} as step, count(*) as n, count(*) filter (x{i}) as k from h group by stratum" for i in range(quality_rules.STEPS))
STEP_VERDICT = " or ".join(f"up_to = {i} and x{i}" for i in range(quality_rules.STEPS))

RULE_ROWS = ", ".join(f"('{r.verdict}', '{r.host}', '{r.path}')" for r in URL_RULES)
LOWERED = "translate({}, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
RESAMPLED_WORDS = "regexp_extract_all(" + LOWERED.format("coalesce(text, '')") + r", '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

SQL: dict[str, str] = {
    "op13_url_filters": f"""
        with p as (select page_id, {LOWERED.format("coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 1), '')")} as host,
                          coalesce(regexp_extract(url, '://([^/?#]*)([^?#]*)', 2), '') as path,
                          row_number() over () as pos from pages),
        c as (select *, regexp_replace(host, '\\.?(:(80|443)?)?\\z', '') as plain from p),
        u as (select *, case when plain <> '' then plain || regexp_replace(path, '/+\\z', '') end as canonical from c),
        f as (select pos, arg_max(r.verdict, length(r.host || r.path)) as verdict, arg_max(r.host || r.path, length(r.host || r.path)) as rule
              from u join (values {RULE_ROWS}) r(verdict, host, path)
              on (u.host = r.host or ends_with(u.host, '.' || r.host)) and starts_with(u.path, r.path) group by pos),
        v as (select u.*, f.rule, f.verdict from u left join f on u.pos = f.pos),
        h as (select host from v where host <> '' group by host having 2 * count(*) filter (verdict = 'block') >= count(*)),
        l as (select distinct canonical from v where host in (select host from h) and canonical is not null)
        select page_id, host, path, rule, coalesce(verdict, case when canonical in (select canonical from l) then 'block' else 'allow' end) as verdict
        from v
    """,
    "op12_resampling": f"""
        with z as (select list(list_reduce(list_prepend(i::bigint, range(8)), lambda c, k: case when c & 1 = 1
                              then xor(c >> 1, 3988292384) else c >> 1 end) order by i) as t from range(256) r(i)),
        d as (select doc_id, row_number() over () as pos, {RESAMPLED_WORDS} as w from documents),
        b as (select {RESAMPLED_WORDS} as w from benchmark),
        x as (select pos, unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                     || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as f from d),
        y as (select unnest(w || list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1])
                     || list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2])) as f from b),
        n as (select f, hex(encode(f)) as h from (select f from x union select f from y)),
        k as (select f, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(len(h) // 2), lambda i: ('0x' || substr(h, 2 * i + 1, 2))::bigint)),
                     lambda c, e: xor(c >> 8, t[(xor(c, e) & 255) + 1])), 4294967295) % {resampling.BUCKETS} as bucket from n, z),
        s as (select bucket, count(*) as s from x join k on x.f = k.f group by bucket),
        t as (select bucket, count(*) as t from y join k on y.f = k.f group by bucket),
        g as (select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * ((select count(*) from x) + {resampling.BUCKETS})
                     / ((s + 1)::double * ((select count(*) from y) + {resampling.BUCKETS}))))::bigint as gain from s left join t using (bucket)),
        w as (select pos, count(*) as n_features, sum(gain)::bigint as weight from x join k on x.f = k.f join g using (bucket) group by pos),
        o as (select d.doc_id, d.pos, len(w) as n_words, coalesce(n_features, 0) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0)
                     + floor(-1000 * ln(-ln((('0x' || substr(sha256('{resampling.SEED}:' || coalesce(doc_id::varchar, '')), 1, 8))::bigint + 0.5)::double / 4294967296)))::bigint as score
              from d left join w on d.pos = w.pos),
        r as (select *, row_number() over (order by n_words >= {resampling.MIN_WORDS} desc, score desc, doc_id nulls last, pos) as place,
                     count(*) filter (n_words >= {resampling.MIN_WORDS}) over () as n from o)
        select doc_id, n_features, weight, score, case when place <= {resampling.PERCENT} * n // 100 then place end as rank from r
    """,
    "op10_quality_rules": f"""
        with d as (select doc_id, coalesce(lang, '') as stratum, coalesce(text, '') as text from documents),
        w as (select doc_id, unnest(regexp_extract_all(text, '[^\x20\x09-\x0D]+')) as word,
                     generate_subscripts(regexp_extract_all(text, '[^\x20\x09-\x0D]+'), 1) as i from d),
        t as (select *, case when lead(word, 2) over p is not null
                             then word || ' ' || lead(word) over p || ' ' || lead(word, 2) over p end as win
              from w window p as (partition by doc_id order by i)),
        r as (select doc_id, word, i, win is not null and count(*) over (partition by doc_id, win) > 1 as again from t),
        c as (select doc_id, word, max(again::int) over (partition by doc_id order by i rows between 2 preceding and current row) as inside from r),
        wc as (select doc_id, count(*) as n_words, sum(length(word)) as word_chars, sum(inside) as n_repeat_words from c group by doc_id),
        l as (select doc_id, unnest(string_split(text, chr(10))) as line from d),
        lc as (select doc_id, count(*) as n_lines, count(*) - count(distinct line) as n_dup_lines from l
               where regexp_matches(line, '[^\x20\x09-\x0D]') group by doc_id),
        f as (select d.doc_id, stratum, coalesce(n_words, 0)::bigint as n_words, coalesce(word_chars, 0)::bigint as word_chars,
                     len(regexp_extract_all(text, '[#*$%&|<>]'))::bigint as n_symbols, coalesce(n_dup_lines, 0)::bigint as n_dup_lines,
                     coalesce(n_repeat_words, 0)::bigint as n_repeat_words, coalesce(n_lines, 0) as n_lines,
                     len(regexp_extract_all(text, '[A-Z]')) as n_upper, len(regexp_extract_all(text, '!')) as n_exclamations
              from d left join wc on d.doc_id = wc.doc_id left join lc on d.doc_id = lc.doc_id),
        s as (select *, n_words < {quality_rules.MIN_WORDS} or 100 * n_repeat_words > {quality_rules.REPEAT_PERCENT} * n_words as base_failed from f),
        v as (select *, {STEP_FAILS} from s),
        g as (select distinct doc_id from labels where quality = 1),
        h as (select v.* from v semi join g on v.doc_id = g.doc_id where not base_failed),
        k as ({STEP_COUNTS}),
        z as (select n, sum(count(*)) over (order by n desc) as m from (select stratum, any_value(n) as n from k group by stratum) group by n),
        b as (select arg_max(n, (least(m, c), n)) as least, arg_max(m, (least(m, c), n)) as m
              from (select *, floor({quality_rules.LEVEL} * exp(least(n * -ln(1 - {quality_rules.RISK}), 40))) as c from z) where c > 0),
        p as (select k.*, case when k >= n * {quality_rules.RISK} then false else list_sum([exp(lgamma(n + 1) - lgamma(i + 1) - lgamma(n - i + 1)
                     + i * ln({quality_rules.RISK}) + (n - i) * ln(1 - {quality_rules.RISK})) for i in range(k + 1)]) <= {quality_rules.LEVEL} / b.m end as passed
              from k, b where n >= least),
        o as (select stratum, coalesce(min(step) filter (not passed), {quality_rules.STEPS}) - 1 as up_to from p group by stratum)
        select doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
               not base_failed and not coalesce({STEP_VERDICT}, false) as kept
        from v left join o on v.stratum = o.stratum and up_to >= 0
    """,
    "op3_line_dedup": f"""
        with d as (select doc_id, coalesce(text, '') as text from documents),
        l as (select doc_id, unnest(string_split(text, chr(10))) as line, generate_subscripts(string_split(text, chr(10)), 1) as i from d),
        f as (select *, ('0x' || substr(md5(line), 1, 12))::bigint as h, len(regexp_extract_all(line, '[^\x20\x09-\x0D]+')) as w from l),
        r as (select *, (coalesce(lag(h) over p, 0) * {line_dedup.FACTOR} + h) % {line_dedup.MODULUS} as r from f
              window p as (partition by doc_id order by i)),
        b as (select *, r < coalesce(lag(r) over p, {line_dedup.MODULUS}) and r <= coalesce(lead(r) over p, {line_dedup.MODULUS})
                     or w > {line_dedup.LONG_LINE} or coalesce(lead(w) over p, 0) > {line_dedup.LONG_LINE} as ends from r
              window p as (partition by doc_id order by i)),
        n as (select *, coalesce(sum(ends::int) over (partition by doc_id order by i rows between unbounded preceding and 1 preceding), 0) as k from b),
        c as (select doc_id, k, string_agg(line, chr(10) order by i) as chunk, count(*) as n_lines, sum(w) as w from n group by all),
        o as (select *, row_number() over (partition by chunk order by doc_id, k) > 1
                     and (n_lines >= {line_dedup.MIN_LINES} and w >= {line_dedup.MIN_WORDS} or w > {line_dedup.LONG_LINE}) as again from c),
        p as (select doc_id, i, line || chr(10) || lead(line) over p as pair, w + lead(w) over p as w from n window p as (partition by doc_id order by i)),
        q as (select doc_id, i, row_number() over (partition by pair order by doc_id, i) > 1 as again from p where pair is not null and w > 0),
        m as (select distinct doc_id, i from (
                  select n.doc_id, n.i from n join o on n.doc_id = o.doc_id and n.k = o.k where o.again
                  union all select doc_id, i from q where again union all select doc_id, i + 1 from q where again)),
        u as (select n.doc_id, n.i, n.w, n.i - row_number() over (partition by n.doc_id order by n.i) as run from n join m on n.doc_id = m.doc_id and n.i = m.i),
        g as (select doc_id, run, count(*) as n_lines from u group by all
              having count(*) >= {line_dedup.MIN_LINES} and sum(w) >= {line_dedup.MIN_WORDS} or sum(w) > {line_dedup.LONG_LINE}),
        x as (select u.doc_id, u.i from u join g on u.doc_id = g.doc_id and u.run = g.run),
        y as (select n.doc_id, coalesce(string_agg(line, chr(10) order by n.i) filter (x.i is null), '') as text
              from n left join x on n.doc_id = x.doc_id and n.i = x.i group by n.doc_id),
        z as (select doc_id, count(*) as n_passages, sum(n_lines)::bigint as n_lines from g group by doc_id)
        select y.doc_id, coalesce(n_passages, 0) as n_removed_chunks, coalesce(n_lines, 0) as n_removed_lines,
               length(text)::bigint as n_chars_left, sha256(text) as left_sha256 from y left join z on y.doc_id = z.doc_id
    """,
    "op9_warc": f"""
        with p as (
            select page_id, encode(coalesce(html, '')) as payload,
                   min(page_id) over (partition by coalesce(html, '')) as first
            from pages
        ), d as (select *, sha1(payload) as digest from p)
        select page_id, octet_length(payload)::bigint as payload_bytes, {BASE32} as payload_digest,
               case when page_id = first then 'response' else 'revisit' end as record_type,
               case when page_id <> first then first end as refers_to
        from d
    """,
}
