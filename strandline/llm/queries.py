"""The registered queries of the numbered operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    bpe, decontaminate, divergence, idfiles, langid, licenses, lm, pii, quality, resample, simhash, token_counts, topk)
from .text import fold


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = decontaminate.contaminated_words(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))
    return decontaminate.report(found)


def op2_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return bpe.encode(_table(spark, sf_dir, "documents"), path, keep="")


def op3_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = quality.quality(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"),
                             learn="crc32(cast(cast(doc_id as string) as binary)) % 5 <> 0")
    return scored.select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


def op4_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"))


def op5_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    model = langid.train(docs.where(fold("doc_id", 5) != 0), public_tokenizers.path("piece_bpe_32k.model"))
    return langid.identify(docs, model).select("doc_id", (fold("doc_id", 5) == 0).alias("held_out"), "lang_pred", "score")


def op6_lm_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = lm.score(_table(spark, sf_dir, "documents"), fold("doc_id", 10) != 0)
    return scored.select("doc_id", (fold("doc_id", 10) == 0).alias("held_out"), "n_tokens", "n_known", "train_tokens",
                         "base_score", "score")


def op7_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    linked = simhash.near_duplicates(_table(spark, sf_dir, "documents"))
    return linked.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op8_pii(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _table(spark, sf_dir, "documents")
    found = pii.find(docs, pii.fit(pii.labelled_table(docs)))
    return found.select("doc_id", "n_email", "n_ip", "n_card", "n_phone", F.sha2("base", 256).alias("base_sha256"), "spans")


def op9_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("word_bpe_49k.json")
    return token_counts.token_counts(_table(spark, sf_dir, "documents"), path)


def op10_id_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return idfiles.round_trip(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


def op11_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(_table(spark, sf_dir, "documents"))


def op12_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(licenses.scan(_table(spark, sf_dir, "documents")))


def op13_resample(spark: SparkSession, sf_dir: str) -> DataFrame:
    return resample.resample(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_decontaminate": op1_decontaminate,
    "op2_bpe": op2_bpe,
    "op3_quality": op3_quality,
    "op4_top_k": op4_top_k,
    "op5_language_id": op5_language_id,
    "op6_lm_score": op6_lm_score,
    "op7_simhash": op7_simhash,
    "op8_pii": op8_pii,
    "op9_token_counts": op9_token_counts,
    "op10_id_files": op10_id_files,
    "op11_source_divergence": op11_source_divergence,
    "op12_license_scan": op12_license_scan,
    "op13_resample": op13_resample,
}

ORACLE: dict[str, str] = {
    "op1_decontaminate": r"""
        with words as (
          select doc_id, row_number() over () as r,
                 coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
          from documents),
        items as (
          select item_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
          from benchmark where item_id is not null and text is not null),
        passages as (
          select distinct cast(item_id as varchar) as item, least(len(w), 10) as n,
                 array_to_string(w[i:i + least(len(w), 10) - 1], ' ') as passage
          from items, unnest(range(1, greatest(len(w) - 10, 0) + 2)) as t(i)
          where len(w) > 0),
        lengths as (select distinct n from passages),
        grams as (
          select r, n, i, array_to_string(w[i:i + n - 1], ' ') as passage
          from words, lengths, unnest(range(1, len(w) - n + 2)) as t(i)
          where len(w) >= n),
        hits as (select r, g.n, i, item from grams g join passages p on g.n = p.n and g.passage = p.passage),
        hit_words as (select r, count(distinct i + j) as n_hit from hits, unnest(range(0, n)) as t(j) group by r),
        hit_items as (select r, count(distinct item) as n_items, string_agg(distinct item, ',' order by item) as items
                      from hits group by r)
        select doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from words left join hit_words using (r) left join hit_items using (r)""",
    "op4_top_k": """
        with usable as (
          select row_number() over () as r, vec_id,
                 list_transform(embedding, lambda x: cast(floor(1024 * cast(x as double)) as bigint)) as v
          from embeddings
          where vec_id is not null and embedding is not null
            and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        scored as (
          select q.r, q.vec_id as query_id, c.vec_id,
                 cast(list_sum(list_transform(range(1, len(q.v) + 1), lambda i: q.v[i] * c.v[i])) as bigint) as score
          from usable q join usable c on q.r <> c.r and len(q.v) = len(c.v)
          where q.vec_id % 100 = 0)
        select query_id, cast(row_number() over (partition by r order by score desc, vec_id) as integer) as rank, vec_id, score
        from scored qualify row_number() over (partition by r order by score desc, vec_id) <= 10""",
    "op11_source_divergence": r"""
        with docs as (
          select row_number() over () as r, coalesce(lang, '') as lang, coalesce(source, '') as source,
                 regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') as w
          from documents),
        words as (select r, lang, source, unnest(w) as term from docs),
        kept as (select lang, term, count(*) as total from words group by lang, term having count(distinct r) >= 3),
        sizes as (select lang, count(*)::hugeint as v, sum(total)::hugeint as n from kept group by lang),
        groups as (select distinct lang, source from docs),
        counts as (select lang, source, term, count(*)::hugeint as c from words join kept using (lang, term) group by all),
        totals as (select lang, source, coalesce(sum(c), 0)::hugeint as n from groups left join counts using (lang, source) group by all),
        shares as (
          select k.lang, t.source, k.term, coalesce(c.c, 0) as c,
                 1 + (1000000000::hugeint * (coalesce(c.c, 0) + 1)) // (t.n + s.v) as p,
                 1 + (1000000000::hugeint * (k.total + 1)) // (s.n + s.v) as q
          from kept k join totals t on k.lang = t.lang join sizes s on k.lang = s.lang
          left join counts c on c.lang = k.lang and c.source = t.source and c.term = k.term),
        pairs as (
          select a.lang, a.source, b.source as item, sum((a.p - b.p) * (a.p - b.p) // b.p) as value
          from shares a join shares b on a.lang = b.lang and a.term = b.term and a.source <> b.source group by all),
        parts as (
          select a.lang, a.source, 'pair' as part, b.source as item, cast(coalesce(p.value, 0) as bigint) as value
          from groups a join groups b on a.lang = b.lang and a.source <> b.source
          left join pairs p on p.lang = a.lang and p.source = a.source and p.item = b.source
          union all
          select lang, source, 'term', term, cast((p - q) * (p - q) // q as bigint) from shares where c > 0 and p > q)
        select *, row_number() over (partition by lang, source, part order by value desc, encode(item)) as rank from parts
        qualify part = 'pair' or rank <= 200""",
    "op13_resample": r"""
        with bits as (
          select list(list_reduce(list_prepend(i, range(8)), lambda c, x: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end)
                      order by i) as t
          from range(256) as r(i)),
        texts as (
          select 0 as side, row_number() over () as r, doc_id, text from documents
          union all select 1, row_number() over (), null, text from benchmark),
        words as (
          select side, r, doc_id,
                 coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), []) as w
          from texts),
        features as (
          select side, r, unnest(list_concat(w, list_transform(range(1, len(w)), lambda i: w[i] || ' ' || w[i + 1]))) as f from words),
        hashed as (
          select f, xor(list_reduce(list_prepend(4294967295::bigint, list_transform(range(strlen(f)),
                     lambda i: cast('0x' || substr(hex(encode(f)), cast(2 * i + 1 as bigint), 2) as bigint))),
                   lambda c, b: xor(c >> 8, t[(xor(c, b) & 255) + 1])), 4294967295) % 10000 as bucket
          from (select distinct f from features), bits),
        counts as (
          select bucket, coalesce(s, 0)::double as s, coalesce(t, 0)::double as t from range(10000) as b(bucket)
          left join (select bucket, count(*) filter (side = 0) as s, count(*) filter (side = 1) as t
                     from features join hashed using (f) group by bucket) using (bucket)),
        gains as (
          select bucket, cast(floor(1000 * ln((t + 1) * (sum(s) over () + 10000) / ((s + 1) * (sum(t) over () + 10000)))) as bigint) as g
          from counts),
        sums as (
          select r, count(*) as n, cast(sum(g) as bigint) as g
          from features join hashed using (f) join gains using (bucket) where side = 0 group by r),
        weighed as (
          select doc_id, len(w) as n_words, coalesce(n, 0) as n_features,
                 coalesce(case when g >= 0 then g // n else -((n - 1 - g) // n) end, 0) as weight
          from words left join sums using (r) where side = 0),
        scored as (
          select doc_id, n_words, n_features, weight,
                 weight + cast(floor(-1000 * ln(-ln((cast('0x' || substr(sha256('7:' || coalesce(doc_id::varchar, '')), 1, 8) as bigint) + 0.5::double)
                                                / 4294967296))) as bigint) as score
          from weighed),
        placed as (
          select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id nulls first) as place,
                 count(*) filter (n_words >= 20) over () as able
          from scored)
        select doc_id, n_features, weight, score, case when n_words >= 20 and place <= 25 * able // 100 then place end as rank
        from placed""",
}
