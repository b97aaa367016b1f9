"""The registered queries of this package and their SQL."""

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_folder
from . import (
    clustering,
    decontaminate,
    exact_dedup,
    license_scan,
    packing,
    quality,
    resampling,
    secret_scan,
    sharding,
    simhash,
    substring_dedup,
    suffix_dedup,
    warc_bundles,
)
from .common import table

SPACE_CLASS = r"[\x20\x09-\x0D]"


def word_bpe() -> str:
    """Path of the public tokenizer that the packing query counts tokens with."""
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def op1_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return substring_dedup.substring_dedup(table(spark, sf_dir, "documents"), window=35)


def op2_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secret_scan.scan_secrets(table(spark, sf_dir, "documents"))


def document_path() -> Column:
    """Documents carry no path: source / thousands / hundreds / file stands for one.

    The first document of each hundred is its folder's licence file.
    """
    number = F.col("doc_id")
    name = F.when(number % 100 == 0, F.lit("LICENSE")).otherwise(F.concat(number, F.lit(".txt")))
    thousands, hundreds = F.floor(number / 1000), F.floor(number / 100)
    return F.concat_ws("/", F.concat(F.lit("part"), thousands), hundreds, F.col("source"), name)


def op3_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    files = table(spark, sf_dir, "documents").withColumn("path", document_path())
    return license_scan.scan_licenses(files)


def op4_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.decontaminate(
        table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    )


def op5_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash.simhash_dedup(table(spark, sf_dir, "documents"), shingle=3, distance=2)


def op6_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(table(spark, sf_dir, "documents"))


def op7_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.classify(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


def op8_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc_bundles.round_trip(table(spark, sf_dir, "pages"), scratch_folder(spark, "warc"))


def op9_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup.suffix_dedup(table(spark, sf_dir, "documents"), window=100)


def op10_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"), word_bpe())


def op11_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, target = table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")
    return resampling.resample(docs, target)


#: Shards of the sharding query.
SHARDS = 24


def op12_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, folder = table(spark, sf_dir, "documents"), scratch_folder(spark, "shards")
    return sharding.shard_digest(docs, folder, SHARDS)


def op13_clustering(spark: SparkSession, sf_dir: str) -> DataFrame:
    return clustering.cluster_digest(table(spark, sf_dir, "embeddings"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_substring_dedup": op1_substring_dedup,
    "op2_secrets": op2_secrets,
    "op3_licenses": op3_licenses,
    "op4_decontaminate": op4_decontaminate,
    "op5_simhash": op5_simhash,
    "op6_exact_dedup": op6_exact_dedup,
    "op7_quality": op7_quality,
    "op8_warc": op8_warc,
    "op9_suffix_dedup": op9_suffix_dedup,
    "op10_packing": op10_packing,
    "op11_resampling": op11_resampling,
    "op12_sharding": op12_sharding,
    "op13_clustering": op13_clustering,
}

#: Table expressions for the CRC-32 of UTF-8 text: the 256 remainders, made from the polynomial.
CRC_TABLES = """
        steps as (
            select i, i as v, 0 as bits from (select unnest(range(256)) as i)
            union all
            select i, case when v & 1 = 1 then xor(v >> 1, 3988292384) else v >> 1 end, bits + 1
            from steps where bits < 8
        ), crc as (select list(v order by i) as remainders from steps where bits = 8)"""


def _crc(text: str) -> str:
    """CRC-32 of a text; the statement must read ``crc``."""
    digits = f"regexp_extract_all(hex(encode({text})), '..')"
    octets = f"list_transform({digits}, lambda h: cast('0x' || h as bigint))"
    return f"""xor(list_reduce({octets},
        lambda c, b: xor(c >> 8, remainders[cast((xor(c, b) & 255) + 1 as bigint)]),
        cast(4294967295 as bigint)), 4294967295)"""


def _draw_cost(key: str) -> str:
    return f"-ln((cast('0x' || substr(md5({key} || ':' || s), 1, 13) as bigint) + 0.5e0) / {float(16**13)!r}e0)"


def _kmeans_sql(rounds: int) -> str:
    """Table expressions c0, a0, c1, a1, ...: centroids and the assignment to them."""
    parts = []
    for i in range(rounds + 1):
        parts.append(f"""
        a{i} as (
            select n, vec_id, v, arg_min(c, (d, c)) as c, min(d) as d
            from (select n, vec_id, v, c,
                         cast(list_sum(list_transform(list_zip(v, w),
                             lambda p: (p[1] - p[2]) * (p[1] - p[2]))) as bigint) as d
                  from kept, c{i})
            group by n, vec_id, v)""")
        if i < rounds:
            parts.append(f"""
        c{i + 1} as (
            select c{i}.c, coalesce(m.w, c{i}.w) as w
            from c{i} left join (
                select c, list(cast(floor(total / cast(n as double)) as bigint) order by i) as w
                from (select c, i, sum(v[i]) as total, count(*) as n
                      from a{i}, range(1, 65) as places(i) group by c, i)
                group by c) m on m.c = c{i}.c)""")
    return ",".join(parts)

SQL: dict[str, str] = {
    "op6_exact_dedup": f"""
        with t as (
            select doc_id, length(coalesce(text, '')) as points,
                   regexp_replace(coalesce(text, ''), '{SPACE_CLASS}', '', 'g') as body
            from documents
        ), g as (
            select body, arg_min(doc_id, (-points, doc_id)) as keep_id, count(*) as group_size
            from t group by body
        )
        select t.doc_id, g.keep_id, g.group_size, t.doc_id = g.keep_id as kept,
               sha256(t.body) as text_sha256
        from t join g using (body)
    """,
    "op8_warc": """
        with p as (
            select page_id, coalesce(html, '') as html,
                   cast(octet_length(encode(coalesce(html, ''))) as bigint) as n
            from pages
        ), w as (
            select *, case when n >= 1000 then max(page_id) over (partition by html) end as newest
            from p
        )
        select page_id, n as payload_bytes, sha1(html) as payload_digest,
               case when page_id < newest then 'revisit' else 'response' end as record_type,
               case when page_id < newest then newest end as refers_to
        from w
    """,
    "op11_resampling": f"""
        with recursive {CRC_TABLES}, texts as (
            select 'd' as side, doc_id as id, text from documents
            union all select 'b', item_id, text from benchmark
        ), words as (
            select side, id, unnest(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+')) as word
            from texts
        ), coded as (
            select word, {_crc("word")} % 10000 as bucket from (select distinct word from words), crc
        ), counted as (
            select bucket, count(*) filter (where side = 'd') as s,
                   count(*) filter (where side = 'b') as t
            from words join coded using (word) group by bucket
        ), gains as (
            select bucket, cast(floor(1000 * ln((t + 1e0) * (sum(s) over () + 10000e0)
                       / ((s + 1e0) * (sum(t) over () + 10000e0)))) as bigint) as gain
            from counted
        ), weighed as (
            select doc_id, coalesce(n, 0) as n_features,
                   coalesce(cast(floor(total / cast(n as double)) as bigint), 0) as weight
            from documents left join (
                select id, count(*) as n, sum(gain) as total
                from words join coded using (word) join gains using (bucket)
                where side = 'd' group by id) on id = doc_id
        ), scored as (
            select *, weight + cast(floor(-1000 * ln(-ln(
                (cast('0x' || substr(sha256('2024:' || doc_id), 1, 8) as bigint) + 0.5e0)
                    / 4294967296e0))) as bigint) as score
            from weighed
        ), placed as (
            select doc_id, row_number() over (order by score desc, doc_id) as place,
                   count(*) over () as n
            from scored where n_features >= 20
        )
        select doc_id, n_features, weight, score, case when place <= 10 * n // 100 then place end as rank
        from scored left join placed using (doc_id)
    """,
    "op12_sharding": f"""
        with recursive {CRC_TABLES}, d as (
            select doc_id, octet_length(encode(coalesce(text, ''))) + 8 as size,
                   {_crc("coalesce(text, '')")} as text_crc32
            from documents, crc
        ), costs as (
            select doc_id, s, {_draw_cost("doc_id")} as cost
            from (select distinct doc_id from documents), range({SHARDS + 1}) as shards(s)
        ), places as (
            select doc_id, cast(arg_min(s, (cost, s)) filter (where s < {SHARDS}) as integer) as shard,
                   cast(arg_min(s, (cost, s)) as integer) as grown_shard
            from costs group by doc_id
        )
        select doc_id, cast(size as bigint) as size, text_crc32, 'key' as law, shard,
               row_number() over (partition by shard order by doc_id, text_crc32) - 1 as slot,
               grown_shard
        from d join places using (doc_id)
    """,
    "op13_clustering": f"""
        with kept as (
            select row_number() over () as n, vec_id,
                   list_transform(embedding, lambda x: cast(floor(64 * cast(x as double)) as bigint)) as v
            from embeddings
            where len(embedding) = 64
              and len(list_filter(embedding, lambda x: x is not null and isfinite(x))) = 64
        ), c0 as (
            select row_number() over (order by sha256('1:' || vec_id)) - 1 as c, v as w
            from kept order by c limit 16
        ), {_kmeans_sql(3)}, sums as (select c, sum(d) as own from a3 group by c)
        select vec_id, cast(a3.c as integer) as "cluster", d as distance,
               cast(own as bigint) as cluster_inertia,
               cast((select sum(own) from sums) as bigint) as inertia,
               sha256(array_to_string(w, ',')) as centroid_sha256
        from a3 join sums on sums.c = a3.c join c3 on c3.c = a3.c
    """,
}
