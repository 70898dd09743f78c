"""Each operator under its production parameters, applied to the whole of its table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallybook.llm import (
    bitplanes,
    exact,
    jaccard,
    langid,
    maintext,
    mixing,
    pieces,
    resampling,
    substring,
    surrogates,
    token_files,
    topk,
    toxicity,
)

END_ID = 2
#: Who knows the key can test guesses at replaced values; a real run passes its own.
SURROGATE_KEY = "surrogates"


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def op1_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    path = token_files.new_shard_folder(spark)
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    token_files.write_shards(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID, path)
    return token_files.read_shards(spark, path, digests=True)


def op2_substring_repeats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring.remove_repeats(_documents(spark, sf_dir), digests=True)


def op3_shingle_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return jaccard.linked_components(_documents(spark, sf_dir))


def op4_integer_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % 20 == 0, 20)


def op5_piece_codec(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir).select("doc_id", "text")
    return pieces.encode_texts(docs, public_tokenizers.path("piece_bpe_32k.model"), digests=True)


def op6_surrogates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return surrogates.replace_entities(_documents(spark, sf_dir), SURROGATE_KEY)


def _remainder(modulus: int):
    return F.crc32(F.col("doc_id").cast("string")) % modulus


def op7_language_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    filters = langid.fit(docs.where(_remainder(5) != 0).select("doc_id", "text", "lang"))
    rows = docs.select("doc_id", F.coalesce(_remainder(5) == 0, F.lit(False)).alias("held_out"), "text")
    return langid.predict(rows, filters)


def op8_exact_groups(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact.exact_groups(_documents(spark, sf_dir), keep="largest")


def op9_source_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix(_documents(spark, sf_dir)).select("doc_id", "size", "source_size", "target", "taken")


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _documents(spark, sf_dir)
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    model = toxicity.fit_documents(docs.where(_remainder(4) != 2), labels)
    rows = docs.select("doc_id", F.coalesce(_remainder(4) == 2, F.lit(False)).alias("held_out"), "text")
    return toxicity.score(rows, model)


def op11_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = spark.read.parquet(f"{sf_dir}/benchmark.parquet").select("text")
    return resampling.resample(_documents(spark, sf_dir), target)


def op12_bitplane_clusters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bitplanes.cluster(spark.read.parquet(f"{sf_dir}/embeddings.parquet"))


def op13_main_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return maintext.extract(pages, maintext.fit(pages))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_token_files": op1_token_files,
    "op2_substring_repeats": op2_substring_repeats,
    "op3_shingle_join": op3_shingle_join,
    "op4_integer_top_k": op4_integer_top_k,
    "op5_piece_codec": op5_piece_codec,
    "op6_surrogates": op6_surrogates,
    "op7_language_filters": op7_language_filters,
    "op8_exact_groups": op8_exact_groups,
    "op9_source_mix": op9_source_mix,
    "op10_toxicity": op10_toxicity,
    "op11_importance_resampling": op11_importance_resampling,
    "op12_bitplane_clusters": op12_bitplane_clusters,
    "op13_main_text": op13_main_text,
}

_LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_SIZE = r"coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)"

_LOWER_ONLY = "translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_FEATURE_WORDS = rf"coalesce(regexp_extract_all({_LOWER_ONLY}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+'), [])"


def _floored(total: str, n: str) -> str:
    """Exact floor of a quotient of integers."""
    return f"((({total}) - ((({total}) % ({n})) + ({n})) % ({n})) // ({n}))"


def _features(table: str) -> str:
    return f"""select row, words, words || list_transform(range(1, len(words)), lambda i: words[i] || ' ' || words[i + 1]) as features
        from (select *, {_FEATURE_WORDS} as words from {table})"""


_RESAMPLING_SQL = f"""
    with recursive steps(i, n, c) as (
        select range::bigint, 0, range::bigint from range(256)
        union all
        select i, n + 1, case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end from steps where n < 8
    ),
    crc as (select list(c order by i) as t from steps where n = 8),
    d as (select row_number() over () as row, doc_id, text from documents),
    b as (select row_number() over () as row, text from benchmark),
    df as ({_features('d')}),
    bf as ({_features('b')}),
    docs as (select row, unnest(features) as f from df),
    aims as (select unnest(features) as f from bf),
    names as (select f from docs union select f from aims),
    coded as (
        select f, list_transform(range(0, strlen(f)), lambda j: 16 * (instr('0123456789ABCDEF', substr(hex(f), 2 * j + 1, 1)) - 1)
            + instr('0123456789ABCDEF', substr(hex(f), 2 * j + 2, 1)) - 1)::bigint[] as bytes from names
    ),
    buckets as (
        select f, xor(list_reduce(list_prepend(4294967295::bigint, bytes), lambda c, x: xor(c >> 8, t[(xor(c, x) & 255) + 1])), 4294967295) % 10000 as bucket
        from coded, crc
    ),
    s as (select bucket, count(*) as s from docs join buckets using (f) group by bucket),
    t as (select bucket, count(*) as t from aims join buckets using (f) group by bucket),
    gains as (
        select bucket, floor(1000 * ln((coalesce(t, 0) + 1)::double * ((select count(*) from docs) + 10000)
            / ((coalesce(s, 0) + 1)::double * ((select count(*) from aims) + 10000))))::bigint as gain
        from (select distinct bucket from buckets) left join s using (bucket) left join t using (bucket)
    ),
    sums as (select row, sum(gain)::bigint as total, count(*) as n from docs join buckets using (f) join gains using (bucket) group by row),
    noise as (
        select row, list_reduce(list_transform(range(1, 9), lambda i: instr('0123456789abcdef', substr(sha256('7:' || doc_id), i, 1)) - 1),
            lambda a, x: 16 * a + x)::double as h from d
    ),
    scored as (
        select d.row, doc_id, coalesce(n, 0) as n_features, len(words) as n_words,
            case when n > 0 then {_floored('total', 'n')} else 0 end::bigint as weight, h
        from d join df using (row) join noise using (row) left join sums using (row)
    ),
    full_score as (select *, weight + floor(-1000 * ln(-ln((h + 0.5) / 4294967296)))::bigint as score from scored),
    ranked as (
        select *, row_number() over (partition by n_words >= 20 order by score desc, doc_id) as place,
            (select 25 * count(*) // 100 from full_score where n_words >= 20) as drawn
        from full_score
    )
    select doc_id, n_features::bigint as n_features, weight, score, case when n_words >= 20 and place <= drawn then place end::bigint as rank
    from ranked"""


def _clusters_sql() -> str:
    """Centroids 0 to 3 rounds on, one table of centroids and one of assignments for each."""
    distance = "list_sum(list_transform(range(1, 65), lambda i: (e.v[i] - c.v[i]) * (e.v[i] - c.v[i])))"
    parts = [
        """e as (
            select row_number() over () as row, vec_id, list_transform(embedding, lambda x: floor(64 * x::double)::bigint) as v from embeddings
            where len(embedding) = 64 and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
        )""",
        "c0 as (select row_number() over (order by sha256('1:' || vec_id)) - 1 as k, v from e qualify k < 16)",
    ]
    for n in range(4):
        parts.append(
            f"""a{n} as (
                select row, vec_id, e.v, k, {distance} as distance from e, c{n} c
                qualify row_number() over (partition by row order by distance, k) = 1
            )"""
        )
        if n < 3:
            parts.append(
                f"""m{n} as (
                    select k, list({_floored('total', 'n')} order by place) as v from (
                        select k, place, sum(x)::bigint as total, count(*) as n
                        from (select k, unnest(v) as x, generate_subscripts(v, 1) as place from a{n}) group by k, place
                    ) group by k
                )"""
            )
            parts.append(f"c{n + 1} as (select k, coalesce(m.v, c.v) as v from c{n} c left join m{n} m using (k))")
    return f"""with {', '.join(parts)}
        select vec_id, k::int as cluster, distance::bigint as distance, (sum(distance) over (partition by k))::bigint as cluster_inertia,
            (sum(distance) over ())::bigint as inertia, sha256(array_to_string(c3.v, ',')) as centroid_sha256
        from a3 join c3 using (k)"""


ORACLE_SQL: dict[str, str] = {
    "op8_exact_groups": f"""
        with t as (select doc_id, {_LOWER} as norm from documents),
        g as (select norm, count(*) as group_size, max(doc_id) as keep_id from t group by norm)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(norm) as text_sha256
        from t join g using (norm)""",
    "op9_source_mix": f"""
        with recursive d as (
            select doc_id, source, {_SIZE}::bigint as size, substr(md5('mix/' || doc_id::varchar), 1, 16) as key
            from documents
        ),
        s as (
            select source, sum(size)::bigint as source_size,
                   (row_number() over (order by source nulls last) - 1) % 3 + 1 as weight
            from d group by source
        ),
        -- Sources in the order in which they reach their limit; the level is right once the next is below it.
        o as (
            select *, 3 * source_size as most,
                   sum(source_size) over () - coalesce(sum(3 * source_size) over w, 0) as spare,
                   sum(weight) over () - coalesce(sum(weight) over w, 0) as heavy
            from s
            window w as (order by 3.0 * source_size / weight, source nulls last rows between unbounded preceding and 1 preceding)
        ),
        level as (
            select spare::bigint as spare, heavy::bigint as heavy from o
            where weight * spare <= most * heavy order by 3.0 * source_size / weight, source nulls last limit 1
        ),
        t as (
            select source, source_size,
                   case when weight * spare > most * heavy then most::double
                        else (weight * spare)::double / heavy end as target
            from s, level, lateral (select 3 * source_size as most)
        ),
        p as (
            select d.*, t.source_size, t.target, floor(t.target)::bigint as budget,
                   coalesce(sum(size) over (partition by d.source order by key, doc_id, size
                       rows between unbounded preceding and 1 preceding), 0)::bigint as before
            from d join t on d.source is not distinct from t.source
        )
        select doc_id, size, source_size, target,
               case when source_size = 0 then 0
                    else (budget // source_size) * size
                         + least(greatest(budget % source_size - before, 0), size) end::bigint as taken
        from p""",
    "op11_importance_resampling": _RESAMPLING_SQL,
    "op12_bitplane_clusters": _clusters_sql(),
}
