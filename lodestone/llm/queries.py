"""The registered queries of this subpackage and their DuckDB SQL."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession, functions as F

from lodestone.functions.json import computed_once
from lodestone.llm import (
    collocations,
    embedding_dedup,
    exact_dedup,
    language,
    line_dedup,
    mixing,
    periodic_runs,
    pieces,
    repeats,
    sharding,
    simhash,
    topk,
    warc,
)

#: Target shares of all tokens, and the SentencePiece model that texts are encoded with.
MIX = {"high": 0.82, "low": 0.13, "toxic": 0.05}
MODEL = "/opt/tokenizers/piece_bpe_32k.model"


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = simhash.near_duplicates(_table(spark, sf_dir, "documents"), words=4, radius=4)
    return found.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def op2_language(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, fold = _table(spark, sf_dir, "documents"), language.fold("doc_id")
    found = language.predict(docs, language.fit(docs, fold != 2))
    return found.select("doc_id", F.coalesce(fold == 2, F.lit(False)).alias("held_out"), "lang_pred", "score")


def op3_top_k(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(_table(spark, sf_dir, "embeddings"), k=5, every=50, scale=256)


def op4_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed, _ = mixing.mix(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"), MIX, columns=["doc_id"])
    shares = [F.col("posterior")[k].alias(f"p_{name}") for k, name in enumerate(mixing.DOMAINS)]
    return mixed.select("doc_id", "n_tokens", *shares, "rate", "copies")


def op5_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return warc.round_trip(_table(spark, sf_dir, "pages"), least=100).drop("url")


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = repeats.remove_repeats(_table(spark, sf_dir, "documents"), width=100)
    return found.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return embedding_dedup.near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.98)


def op8_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = line_dedup.deduplicate_lines(_table(spark, sf_dir, "documents"), percent=80)
    return found.select("doc_id", "n_lines", "n_removed", F.sha2(F.coalesce("text", F.lit("")), 256).alias("kept_sha256"))


def op9_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.assign_shards(_table(spark, sf_dir, "documents"), shards=40, overhead=16)


def op10_pieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = pieces.encode(_table(spark, sf_dir, "documents"), MODEL, n=2)
    digest = F.sha2(F.array_join("piece_ids", " "), 256).alias("ids_sha256")
    others = F.array_join(F.transform("next_best", lambda x: F.array_join(x["ids"], " ")), "\n")
    following = F.when(F.size("next_best") > 0, F.sha2(others, 256)).alias("next_ids_sha256")
    return coded.select("doc_id", F.size("piece_ids").alias("n_pieces"), digest, "piece_score", following, "next_score", "decodes")


def _made_periodic(docs: DataFrame) -> DataFrame:
    """``(doc_id, text)`` where a tenth of the texts repeat a stretch of themselves to their end."""
    h = F.crc32(F.col("doc_id").cast("string"))
    chosen = computed_once(docs.select("doc_id", "text"), h=h, g=F.floor(h / 10))
    words = F.filter(F.split("text", r"[\x20\x09-\x0D]+"), lambda w: w != "")
    split = computed_once(chosen, words=F.when(F.col("h") % 10 == 0, words))
    n, g = F.size("words"), F.col("g")
    start = F.when(n > 0, g % n)
    period = (1 + F.floor((n - start) / (3 + g % 8))).cast("long")
    placed = computed_once(split, a=start, p=period)
    a, p = F.col("a"), F.col("p")
    turned = F.transform("words", lambda w, i: F.when(i < a, w).otherwise(F.get("words", (a + (i - a) % p).cast("int"))))
    return placed.select("doc_id", F.when(a.isNotNull(), F.array_join(turned, " ")).otherwise(F.col("text")).alias("text"))


def op11_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = _made_periodic(_table(spark, sf_dir, "documents"))
    found = periodic_runs.periodic_runs(docs, least_length=24, least_exponent=3, columns=["doc_id"])
    line = lambda r: F.concat_ws(",", r["start"], r["length"], r["period"])
    lines = F.array_join(F.transform("runs", lambda r: F.concat(line(r), F.lit("\n"))), "")
    best = F.col("strongest")
    return found.select(
        "doc_id",
        F.size("runs").cast("long").alias("n_runs"),
        *[best[name].alias(name) for name in ("start", "length", "period")],
        F.expr("(1000 * strongest.length) div strongest.period").alias("exponent_milli"),
        F.sha2(lines, 256).alias("runs_sha256"),
        F.sha2("collapsed", 256).alias("collapsed_sha256"),
    )


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), longest=4, least=30, cover=80, top=2000)


def op13_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_duplicates(_table(spark, sf_dir, "documents"), keep="largest", columns=["doc_id"])


ALL = [
    op1_simhash,
    op2_language,
    op3_top_k,
    op4_mixing,
    op5_warc,
    op6_suffix_dedup,
    op7_embedding_dedup,
    op8_line_dedup,
    op9_sharding,
    op10_pieces,
    op11_periodic_runs,
    op12_collocations,
    op13_exact_dedup,
]

ORACLE = {
    "op12_collocations": """
        with pieces as (
            select coalesce(lang, 'und') as lang,
                   unnest(regexp_split_to_array(
                       translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                       '[.,;:!?\\x0A-\\x0D]')) as piece
            from documents),
        split as (
            select lang, list_filter(regexp_split_to_array(piece, '[\\x20\\x09]+'), lambda w: w <> '') as words from pieces),
        places as (select lang, words, unnest(range(1, len(words) + 1)) as i from split),
        counted as (
            select lang, k, array_to_string(words[i:i + k - 1], ' ') as phrase, count(*) as f
            from places, (values (1), (2), (3), (4)) as sizes(k)
            where i + k - 1 <= len(words) group by all having count(*) >= 30),
        totals as (select lang, count(*) as n from places group by lang),
        cuts as (
            select c.lang, c.phrase, c.k as size, c.f as a, cut,
                   array_to_string(string_split(c.phrase, ' ')[1:cut], ' ') as head,
                   array_to_string(string_split(c.phrase, ' ')[cut + 1:], ' ') as tail
            from counted c, (values (1), (2), (3)) as places(cut) where cut < c.k),
        scored as (
            select cuts.lang, cuts.phrase, size, a, cut, x.f as l, y.f as r,
                   ((2000000::hugeint * a) // (x.f + y.f))::bigint as score
            from cuts join counted x on x.lang = cuts.lang and x.phrase = head
            join counted y on y.lang = cuts.lang and y.phrase = tail),
        candidates as (
            select * from scored qualify row_number() over (partition by lang, phrase order by score, cut) = 1),
        inner_phrases as (
            select lang, array_to_string(string_split(phrase, ' ')[s:s + m - 1], ' ') as phrase, max(a) as longer
            from candidates, (values (2), (3)) as lengths(m), (values (1), (2), (3)) as starts(s)
            where m < size and s + m - 1 <= size group by all),
        left_over as (
            select c.* from candidates c left join inner_phrases i on i.lang = c.lang and i.phrase = c.phrase
            where longer is null or 100::hugeint * longer < 80::hugeint * a),
        ranked as (
            select *, row_number() over (partition by lang order by score desc, a desc, phrase) as rank from left_over)
        select lang, rank, phrase, a, l, r, n, score from ranked join totals using (lang) where rank <= 2000
    """,
    "op13_exact_dedup": """
        with rows as (
            select doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as body
            from documents),
        groups as (select body, max(doc_id) as keep_id, count(*) as group_size from rows group by body)
        select doc_id, keep_id, group_size, doc_id = keep_id as kept, sha256(body) as text_sha256
        from rows join groups using (body)
    """,
    "op3_top_k": """
        with whole as (
            select vec_id, list_transform(embedding, lambda x: floor(256 * x::double)::bigint) as q
            from embeddings
            where vec_id is not null and embedding is not null
              and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0),
        pairs as (
            select a.vec_id as query_id, b.vec_id as vec_id,
                   list_sum(list_transform(list_zip(a.q, b.q), lambda p: p[1] * p[2]))::bigint as score
            from (select distinct vec_id, q from whole where vec_id % 50 = 0) a
            join whole b on b.vec_id <> a.vec_id and len(a.q) = len(b.q)),
        ranked as (
            select *, row_number() over (partition by query_id order by score desc, vec_id)::int as rank from pairs)
        select query_id, rank, vec_id, score from ranked where rank <= 5
    """,
    "op5_warc": """
        with rows as (
            select page_id, strlen(coalesce(html, ''))::bigint as payload_bytes, sha256(coalesce(html, '')) as payload_digest
            from pages),
        firsts as (select payload_digest, min(page_id) as first from rows where payload_bytes >= 100 group by 1)
        select page_id, payload_bytes, payload_digest,
               case when first is not null and page_id is distinct from first then 'revisit' else 'response' end as record_type,
               case when page_id is distinct from first then first end as refers_to
        from rows left join firsts using (payload_digest)
    """,
    "op7_embedding_dedup": """
        with recursive usable as (
            select vec_id, label, embedding::double[] as x from embeddings
            where embedding is not null and label is not null
              and len(list_filter(embedding, lambda c: c is null or not isfinite(c))) = 0
              and len(list_filter(embedding, lambda c: c <> 0)) > 0),
        links as (
            select a.vec_id as u, b.vec_id as v from usable a
            join usable b on a.label = b.label and a.vec_id <> b.vec_id and len(a.x) = len(b.x)
            where list_cosine_similarity(a.x, b.x) >= 0.98),
        reach as (
            select vec_id as u, vec_id as v from embeddings
            union select reach.u, links.v from reach join links on reach.v = links.u),
        named as (select u as vec_id, min(v) as component_id from reach group by u)
        select vec_id, (select count(*) from links where u = vec_id)::bigint as n_links, component_id,
               vec_id = component_id as kept
        from named
    """,
    "op8_line_dedup": """
        with lines as (
            select doc_id, number - 1 as number, line,
                   list_sort(list_distinct(list_filter(
                       regexp_split_to_array(line, '[\\x09-\\x0D ]+'), lambda w: w <> ''))) as words
            from (select doc_id, unnest(string_split(text, chr(10))) as line,
                         generate_subscripts(string_split(text, chr(10)), 1) as number
                  from documents where text is not null)),
        sets as (
            select words, len(words) as n, min((doc_id, number)) as first from lines where len(words) > 0 group by words),
        words as (select first, n, unnest(words) as word from sets),
        counted as (select word, count(*) as df from words group by word),
        heads as (
            select * from (
                select first, n, word, row_number() over (partition by first order by df, word) as place
                from words join counted using (word))
            where place <= n - ceil(0.8 * n) + 1),
        met as (
            select distinct a.first as later, b.first as earlier from heads a join heads b
            on a.word = b.word and b.first < a.first and 5 * b.n >= 4 * a.n and 5 * a.n >= 4 * b.n),
        matched as (
            select distinct later as first from met join sets a on a.first = later join sets b on b.first = earlier
            where 9 * len(list_intersect(a.words, b.words)) >= 4 * (a.n + b.n)),
        kept as (select first from sets where first not in (select first from matched)),
        judged as (
            select doc_id, number, line, len(words) > 0 as counted,
                   len(words) > 0 and (doc_id, number) not in (select first from kept) as removed
            from lines)
        select d.doc_id, count(*) filter (counted)::int as n_lines, count(*) filter (removed)::int as n_removed,
               sha256(coalesce(string_agg(line, chr(10) order by number) filter (not removed), '')) as kept_sha256
        from documents d left join judged j on d.doc_id = j.doc_id group by d.doc_id
    """,
}
