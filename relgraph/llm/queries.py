"""The registered queries of the subpackage: each applies one operator to its
whole table and reduces the operator's output to the columns agreed on."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from relgraph.llm.benchmark_search import find_benchmark, words_hit
from relgraph.llm.chat_format import format_chats, read_loss, read_turns
from relgraph.llm.importance import importance_resample
from relgraph.llm.language_crf import identify_languages, train, training_sample
from relgraph.llm.license_scan import scan_licenses
from relgraph.llm.near_dups import fingerprint_hex, near_duplicate_groups
from relgraph.llm.packing import pack_documents
from relgraph.llm.personal_data import BASE_KINDS, count_of, find_personal_data, joined_spans
from relgraph.llm.prefix_trie import prefix_trie
from relgraph.llm.quality_model import classify_quality
from relgraph.llm.quality_rules import apply_quality_rules
from relgraph.llm.scan import read_documents
from relgraph.llm.secret_scan import scan_secrets
from relgraph.llm.tokens import count_tokens


def op1_near_dups(spark: SparkSession, folder: str) -> DataFrame:
    groups = near_duplicate_groups(read_documents(spark, folder), keep=["doc_id"])
    return groups.select("doc_id", fingerprint_hex(F.col("fingerprint")).alias("fingerprint"), "component_id")


def op2_chats(spark: SparkSession, folder: str) -> DataFrame:
    """Digests of what can be read back.  A digest is over a whole conversation, so
    here, unlike in the operator, its texts meet in one row."""
    tricky = "<|im_end|><|im_start|>assistant ok"
    extra = F.array(*[F.struct(F.lit(t).alias("turn"), F.lit(r).alias("role")) for t, r in enumerate(("user", "assistant"))])
    given = read_documents(spark, folder, "conversations").select("conv_id", "turn", "role", "text")
    added = spark.range(1).select(F.lit(-1).alias("conv_id"), F.explode(extra).alias("x")).select(
        F.col("conv_id").cast(given.schema["conv_id"].dataType), F.col("x.turn").cast(given.schema["turn"].dataType), "x.role", F.lit(tricky)
    )
    windows = format_chats(given.union(added))
    read = F.transform(
        read_turns(F.col("formatted"), F.col("n_repeated")), lambda t: F.concat(t["role"], F.lit("\n"), t["text"], F.lit("\n"))
    )
    parts = windows.select(
        "conv_id",
        F.struct("window", F.array_join(read, "").alias("turns"), read_loss(F.col("formatted"), F.col("loss")).alias("loss")).alias("part"),
        (F.col("n_turns") - F.col("n_repeated")).alias("new"),
        F.length("formatted").cast("bigint").alias("chars"),
    )
    whole = parts.groupBy("conv_id").agg(
        F.sum("new").alias("n_turns"), F.sum("chars").alias("formatted_chars"), F.array_sort(F.collect_list("part")).alias("parts")
    )
    turns = F.array_join(F.transform("parts", lambda p: p["turns"]), "")
    loss = F.array_join(F.transform("parts", lambda p: p["loss"]), "")
    return whole.select(
        "conv_id",
        "n_turns",
        F.sha2(turns, 256).alias("turns_sha256"),
        F.length(loss).cast("bigint").alias("loss_chars"),
        F.sha2(loss, 256).alias("loss_sha256"),
        "formatted_chars",
    )


def op3_license_scan(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_licenses(read_documents(spark, folder), keep=["doc_id"])
    words = F.transform("places", lambda p: p["word"])
    base = F.transform("places", lambda p: p["label"])
    both = F.concat(base, F.transform("blocks", lambda b: b["label"]))
    best = F.coalesce(F.array_max(F.transform("blocks", lambda b: b["containment"])), F.lit(0.0))

    def joined(labels):
        return F.array_join(F.array_sort(F.array_distinct(labels)), ",")

    return found.select(
        "doc_id",
        "n_words",
        F.size("places").cast("bigint").alias("n_base"),
        F.array_min(words).alias("first_word"),
        F.array_max(words).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(both).alias("labels"),
        F.when(F.size("places") > 0, 1.0).otherwise(best).alias("score"),
    )


def op4_language(spark: SparkSession, folder: str) -> DataFrame:
    documents = read_documents(spark, folder)
    third = "crc32(cast(doc_id as string)) % 3"
    model = train(training_sample(documents, f"{third} <> 1", "doc_id", "text", "lang"))
    return identify_languages(documents, model, keep=["doc_id"]).select(
        "doc_id", F.expr(f"coalesce({third} = 1, false)").alias("held_out"), "lang_pred", "score"
    )


def op5_quality(spark: SparkSession, folder: str) -> DataFrame:
    documents, labels = read_documents(spark, folder), read_documents(spark, folder, "labels")
    return classify_quality(documents, labels, keep=["doc_id"]).select(
        "doc_id", "text_log_odds", "host_rate", "path_rate", "p_bad", "rejected"
    )


def op6_personal_data(spark: SparkSession, folder: str) -> DataFrame:
    found = find_personal_data(read_documents(spark, folder), keep=["doc_id"])
    base = F.filter("spans", lambda s: s["kind"].isin(*BASE_KINDS))
    return found.select(
        "doc_id",
        *[count_of(kind).alias(f"n_{kind}") for kind in BASE_KINDS],
        F.sha2(joined_spans(base), 256).alias("base_sha256"),
        joined_spans(F.col("spans")).alias("spans"),
    )


def op7_secrets(spark: SparkSession, folder: str) -> DataFrame:
    found = scan_secrets(read_documents(spark, folder), keep=["doc_id"])
    secrets = F.filter("findings", lambda f: f["is_secret"])
    return found.select(
        "doc_id",
        F.size("findings").cast("bigint").alias("n_candidates"),
        F.size(secrets).cast("bigint").alias("n_secrets"),
        F.sha2(F.array_join(F.transform(secrets, lambda f: f["value"]), ","), 256).alias("secrets_sha256"),
        F.array_max(F.transform("findings", lambda f: f["score"])).alias("top_score"),
        F.length("redacted").cast("bigint").alias("redacted_chars"),
        F.sha2("redacted", 256).alias("redacted_sha256"),
    )


def op8_packing(spark: SparkSession, folder: str) -> DataFrame:
    return pack_documents(read_documents(spark, folder), keep=["doc_id"]).select(
        "doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"
    )


def op9_quality_rules(spark: SparkSession, folder: str) -> DataFrame:
    return apply_quality_rules(read_documents(spark, folder), keep=["doc_id"]).select(
        "doc_id",
        "n_words",
        "word_chars",
        "n_symbols",
        "n_dup_lines",
        "n_repeat_words",
        "base_failed",
        "kept",
        "ratio",
        "band_verdict",
    )


def op10_benchmark(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = read_documents(spark, folder), read_documents(spark, folder, "benchmark")
    hit = words_hit("runs")
    return find_benchmark(documents, benchmark, keep=["doc_id"]).select(
        "doc_id",
        "n_words",
        hit.alias("n_hit"),
        F.size("items").cast("bigint").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (hit > 0).alias("contaminated"),
    )


def op11_resample(spark: SparkSession, folder: str) -> DataFrame:
    documents, benchmark = read_documents(spark, folder), read_documents(spark, folder, "benchmark")
    return importance_resample(documents, benchmark, keep=["doc_id"]).select("doc_id", "n_features", "weight", "score", "rank")


def op12_token_counts(spark: SparkSession, folder: str) -> DataFrame:
    return count_tokens(read_documents(spark, folder), keep=["doc_id"]).select("doc_id", "n_bytes", "n_tokens", "over_limit")


def op13_prefix_trie(spark: SparkSession, folder: str) -> DataFrame:
    return prefix_trie(read_documents(spark, folder, "conversations"))


QUERIES = {
    "op1_near_dups": op1_near_dups,
    "op2_chats": op2_chats,
    "op3_license_scan": op3_license_scan,
    "op4_language": op4_language,
    "op5_quality": op5_quality,
    "op6_personal_data": op6_personal_data,
    "op7_secrets": op7_secrets,
    "op8_packing": op8_packing,
    "op9_quality_rules": op9_quality_rules,
    "op10_benchmark": op10_benchmark,
    "op11_resample": op11_resample,
    "op12_token_counts": op12_token_counts,
    "op13_prefix_trie": op13_prefix_trie,
}

def _crc32_sql(text: str) -> str:
    """CRC-32 of the bytes of a text in DuckDB's SQL: eight shifts a byte."""
    step = "case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    byte = f"list_reduce(list_prepend(xor(a, b), [0, 0, 0, 0, 0, 0, 0, 0]), lambda c, zero: {step})"
    codes = f"list_transform(range(1, strlen({text}) + 1), lambda i: ('0x' || substr(hex(encode({text})), 2 * i - 1, 2))::bigint)"
    return f"xor(list_reduce(list_prepend(4294967295::bigint, {codes}), lambda a, b: {byte}), 4294967295)"


#: The same rows in SQL, where SQL can say them.
ORACLES = {
    "op10_benchmark": """
        with lists as (
            select 'd' as side, row_number() over () as rid, doc_id as id, text from documents
            union all select 'b', row_number() over (), item_id, text from benchmark),
        words as (
            select side, rid, id, coalesce(regexp_extract_all(
                translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as w from lists),
        items as (select id, w, least(10, len(w)) as k from words where side = 'b' and len(w) > 0),
        windows as (
            select distinct id, k, array_to_string(w[i : i + k - 1], ' ') as p
            from (select *, unnest(range(1, len(w) - k + 2)) as i from items)),
        places as (
            select rid, k, i, array_to_string(w[i : i + k - 1], ' ') as p
            from (select rid, w, k, unnest(range(1, len(w) - k + 2)) as i
                  from words, (select distinct k from items) where side = 'd' and len(w) >= k)),
        hits as (select rid, i, places.k, id from places join windows on places.k = windows.k and places.p = windows.p),
        hit_words as (select rid, count(distinct place) as n_hit from (select rid, unnest(range(i, i + k)) as place from hits) group by rid),
        hit_items as (
            select rid, count(*) as n_items, string_agg(item, ',' order by item) as items
            from (select distinct rid, id::varchar as item from hits where id is not null) group by rid)
        select id as doc_id, len(w) as n_words, coalesce(n_hit, 0) as n_hit, coalesce(n_items, 0) as n_items,
               sha256(coalesce(items, '')) as items_sha256, coalesce(n_hit, 0) > 0 as contaminated
        from words left join hit_words using (rid) left join hit_items using (rid) where side = 'd'""",
    "op11_resample": f"""
        with words as (
            select side, rid, id, unnest(w) as word from (
                select *, coalesce(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                    '[^\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+'), []) as w
                from (select 's' as side, row_number() over () as rid, doc_id as id, text from documents
                      union all select 't', row_number() over (), null, text from benchmark))),
        hashed as (select word, {_crc32_sql("word")} % 10000 as bucket from (select distinct word from words)),
        counts as (
            select bucket, count(*) filter (side = 's') as s, count(*) filter (side = 't') as t
            from words join hashed using (word) group by bucket),
        gains as (
            select bucket, floor(1000 * ln((t + 1.0::double) * ((sum(s) over ()) + 10000)::double
                / ((s + 1.0::double) * ((sum(t) over ()) + 10000)::double)))::bigint as gain from counts),
        means as (
            select rid, count(*) as n, floor(sum(gain)::double / count(*))::bigint as weight
            from words join hashed using (word) join gains using (bucket) where side = 's' group by rid),
        scored as (
            select doc_id, coalesce(n, 0) as n_features, coalesce(weight, 0) as weight, coalesce(weight, 0)
                + floor(-1000 * ln(-ln((('0x' || left(sha256('2024:' || doc_id), 8))::bigint + 0.5::double) / 4294967296.0::double)))::bigint as score
            from (select row_number() over () as rid, doc_id from documents) left join means using (rid)),
        ranked as (
            select *, row_number() over (partition by n_features >= 20 order by score desc, doc_id) as place,
                (select count(*) from scored where n_features >= 20) as n from scored)
        select doc_id, n_features, weight, score, case when n_features >= 20 and place <= n * 10 // 100 then place end as rank
        from ranked""",
    "op13_prefix_trie": f"""
        with turns as (
            select conv_id as c, row_number() over (partition by conv_id order by turn nulls first) - 1 as number,
                {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} as t
            from conversations where conv_id is not null),
        convs as (select c, c - c % 20 as p, h, given, list(t order by number) as own
            from turns join (select distinct c, {_crc32_sql("c::varchar")} % 4 as h from turns) using (c)
            left join (select c as p, list(t order by number) as given from turns where c % 20 = 0 group by c) g on g.p = c - c % 20
            group by all),
        rebuilt as (select c, list_concat(coalesce(given[1:h], []), own[h + 1:]) as l from convs),
        members as (select c, l[1:d] as node, d as depth, d = len(l) as ends
            from (select c, l, unnest(range(0, len(l) + 1)) as d from rebuilt)),
        nodes as (select node, depth, min(c) as conv_id, count(*) as n_convs,
                sha256(coalesce(string_agg(c::varchar, ',' order by c) filter (ends), '')) as ends_sha256
            from members group by node, depth),
        known as (select n.*, p.conv_id as parent_conv_id,
                count(*) over (partition by n.node[1:n.depth - 1], n.depth) as siblings,
                case when n.depth = 0 then 0 else (n.n_convs - 1)
                    * len(regexp_extract_all(n.node[n.depth].text, '[^\\x20\\x09-\\x0D]+')) end as saved
            from nodes n left join nodes p on p.depth = n.depth - 1 and p.node = n.node[1:n.depth - 1]),
        children as (select node[1:depth - 1] as node, count(*) as n_children from known where depth > 0 group by 1),
        full_nodes as (select known.*, coalesce(n_children, 0) as n_children from known left join children using (node)),
        totals as (select top as node, count(*) filter (n_children = 0) as n_leaves, sum(saved)::bigint as saved_tokens
            from (select *, node[1:unnest(range(0, depth + 1))] as top from full_nodes) group by 1)
        select conv_id, depth, parent_conv_id, n_convs, n_children, n_leaves, saved_tokens, ends_sha256
        from full_nodes join totals using (node)""",
}
