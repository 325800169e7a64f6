"""The thin queries: each operator over its whole test table, with production parameters."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tableprofile.llm.alignment import align_tokenizers
from tableprofile.llm.chosen_path import similarity_classes
from tableprofile.llm.compression import compression_bands
from tableprofile.llm.decontamination import find_benchmark
from tableprofile.llm.density import extract_main_text
from tableprofile.llm.descent import nearest
from tableprofile.llm.differencing import shard_documents
from tableprofile.llm.languages import fit_languages, predict_language
from tableprofile.llm.packing import pack_pieces, token_pieces
from tableprofile.llm.pieces import encoding_digest
from tableprofile.llm.quotations import as_mail, reply_conversations
from tableprofile.llm.shared import fold_of
from tableprofile.llm.toxicity import fit_toxicity, score_toxicity
from tableprofile.llm.whitening import whiten


def tokenizer_file(name: str) -> str:
    """Where an installed public tokenizer lies; every machine has the package."""
    import public_tokenizers

    return public_tokenizers.path(name)


def _table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def op1_nn_pu_toxicity(spark: SparkSession, folder: str) -> DataFrame:
    docs, labels = _table(spark, folder, "documents"), _table(spark, folder, "labels")
    remainder = fold_of(F.col("doc_id"), 5)
    model = fit_toxicity(docs, labels, remainder > 0)
    scored = score_toxicity(docs, model)
    return scored.select("doc_id", (remainder == 0).alias("held_out"), "score", "predicted")


def op2_compression_bands(spark: SparkSession, folder: str) -> DataFrame:
    return compression_bands(_table(spark, folder, "documents"))


def op3_quotation_linking(spark: SparkSession, folder: str) -> DataFrame:
    """The turns as mail, where each quotes the two before it; the operator gets them back."""
    mail = as_mail(_table(spark, folder, "conversations"))
    found = reply_conversations(mail)
    return found.select(
        "conv_id", "turn", F.col("parent").alias("parent_turn"), F.col("root").alias("root_turn"),
        "reply_depth", "reply_order", "n_quotes", "n_linked", "text",
    )


def op4_grouping_genetic_packing(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return pack_pieces(token_pieces(docs, tokenizer_file("word_bpe_49k.json")))


def op5_language_families(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    remainder = fold_of(F.col("doc_id"), 4)
    machines = fit_languages(docs, (remainder >= 0) & (remainder != 2))
    found = predict_language(docs, machines)
    return found.select("doc_id", (remainder == 2).alias("held_out"), "lang_pred", "score")


def op6_composite_text_density(spark: SparkSession, folder: str) -> DataFrame:
    return extract_main_text(_table(spark, folder, "pages"))


def op7_karmarkar_karp_shards(spark: SparkSession, folder: str) -> DataFrame:
    return shard_documents(_table(spark, folder, "documents"))


def op8_nn_descent(spark: SparkSession, folder: str) -> DataFrame:
    vectors = _table(spark, folder, "embeddings")
    return nearest(vectors, F.col("vec_id") % 50 == 0)


def op9_chosen_path_join(spark: SparkSession, folder: str) -> DataFrame:
    return similarity_classes(_table(spark, folder, "documents"))


def op10_suffix_array_pieces(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    return encoding_digest(docs, tokenizer_file("piece_bpe_32k.model"))


def op11_suffix_automaton_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs, items = _table(spark, folder, "documents"), _table(spark, folder, "benchmark")
    return find_benchmark(docs, items).select(
        "doc_id", "n_words", "n_hit", F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        (F.col("n_hit") > 0).alias("contaminated"),
    )


def op12_spectrum_slicing_whitening(spark: SparkSession, folder: str) -> DataFrame:
    return whiten(_table(spark, folder, "embeddings"))


def op13_arrow_token_alignment(spark: SparkSession, folder: str) -> DataFrame:
    docs = _table(spark, folder, "documents")
    first, second = tokenizer_file("byte_bpe_50k.json"), tokenizer_file("piece_bpe_32k.model")
    return align_tokenizers(docs, first, second).documents


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    run.__name__: run
    for run in (
        op1_nn_pu_toxicity,
        op2_compression_bands,
        op3_quotation_linking,
        op4_grouping_genetic_packing,
        op5_language_families,
        op6_composite_text_density,
        op7_karmarkar_karp_shards,
        op8_nn_descent,
        op9_chosen_path_join,
        op10_suffix_array_pieces,
        op11_suffix_automaton_decontamination,
        op12_spectrum_slicing_whitening,
        op13_arrow_token_alignment,
    )
}

# A turn answers the earliest turn with the text of the turn before it, or where that has
# no word, of the one before that. The tables have no quote marks of their own.
OP3_SQL = r"""
with recursive turns as (
    select conv_id, turn, text,
           lower(trim(regexp_replace(coalesce(text, ''), '\s+', ' ', 'g'))) as plain
    from conversations
),
one as (select conv_id, turn, min(plain) as plain from turns group by conv_id, turn),
firsts as (
    select conv_id, plain, min(turn) as turn from one where plain <> '' group by conv_id, plain
),
links as (
    select o.conv_id, o.turn, coalesce(f1.turn, f2.turn) as parent,
           coalesce((b1.plain <> '')::int, 0) + coalesce((b2.plain <> '')::int, 0) as quotes,
           (f1.turn is not null)::int + (f2.turn is not null)::int as linked
    from one o
    left join one b1 on b1.conv_id = o.conv_id and b1.turn = o.turn - 1
    left join one b2 on b2.conv_id = o.conv_id and b2.turn = o.turn - 2
    left join firsts f1 on f1.conv_id = o.conv_id and f1.plain = b1.plain and f1.turn < o.turn
    left join firsts f2 on f2.conv_id = o.conv_id and f2.plain = b2.plain and f2.turn < o.turn
),
tree as (
    select conv_id, turn, turn as root, 0::bigint as depth from links where parent is null
    union all
    select l.conv_id, l.turn, t.root, t.depth + 1
    from links l join tree t on t.conv_id = l.conv_id and t.turn = l.parent
)
select c.conv_id, c.turn, l.parent as parent_turn, t.root as root_turn,
       t.depth as reply_depth,
       row_number() over (partition by c.conv_id, t.root order by t.depth, c.turn) - 1
           as reply_order,
       l.quotes::bigint as n_quotes, l.linked::bigint as n_linked,
       regexp_replace(coalesce(c.text, ''), '^\s+|\s+$', '', 'g') as text
from turns c
join links l on l.conv_id = c.conv_id and l.turn = c.turn
join tree t on t.conv_id = c.conv_id and t.turn = c.turn
"""
# Windows are compared as texts of words.
OP11_SQL = r"""
with d as (
    select doc_id, regexp_extract_all(
        translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
        '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w
    from documents
),
i as (
    select item_id, w, least(10, len(w)) as t
    from (select item_id, regexp_extract_all(
              translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                        'abcdefghijklmnopqrstuvwxyz'),
              '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') as w from benchmark)
    where len(w) > 0
),
windows as (
    select distinct item_id, t, array_to_string(w[k : k + t - 1], ' ') as s
    from (select *, unnest(range(1, len(w) - t + 2)) as k from i)
),
runs as (
    select doc_id, t, k, array_to_string(w[k : k + t - 1], ' ') as s
    from (select doc_id, w, t, unnest(range(1, len(w) - t + 2)) as k
          from d, (select distinct t from i))
),
hits as materialized (
    select doc_id, k, r.t as t, item_id from runs r join windows v on v.t = r.t and v.s = r.s
),
marks as (
    select doc_id, count(distinct p) as n_hit
    from (select doc_id, unnest(range(k, k + t)) as p from hits) group by doc_id
),
names as (
    select doc_id, count(*) as n_items, string_agg(item, ',' order by item) as items
    from (select distinct doc_id, cast(item_id as varchar) as item from hits) group by doc_id
)
select d.doc_id, len(d.w)::bigint as n_words, coalesce(n_hit, 0)::bigint as n_hit,
       coalesce(n_items, 0)::bigint as n_items, sha256(coalesce(items, '')) as items_sha256,
       n_hit is not null as contaminated
from d left join marks m on m.doc_id = d.doc_id left join names n on n.doc_id = d.doc_id
"""
SQL: dict[str, str] = {
    "op3_quotation_linking": OP3_SQL,
    "op11_suffix_automaton_decontamination": OP11_SQL,
}
