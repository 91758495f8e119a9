"""One registered query per operator, over its whole table."""

from __future__ import annotations

from pyspark.sql import DataFrame

from starfold.llm.chat import format_conversations, read_back
from starfold.llm.decontaminate import contaminated
from starfold.llm.exact_dedup import duplicate_groups
from starfold.llm.jaccard_join import jaccard_components
from starfold.llm.language_id import language_table
from starfold.llm.packing import pack_documents
from starfold.llm.pii import personal_data
from starfold.llm.registry import ORACLES, QUERIES, query
from starfold.llm.secrets import secrets
from starfold.llm.simhash import near_duplicates
from starfold.llm.token_alignment import align_tokens
from starfold.llm.toxicity import toxicity_table
from starfold.llm.url_filter import judge_urls, labelled_urls, train
from starfold.llm.whitening import whiten

__all__ = ["ORACLES", "QUERIES"]


@query(
    "documents",
    r"""
    with d as (select doc_id, sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g')) as text_sha256
               from documents)
    select doc_id, min(doc_id) over (partition by text_sha256) as keep_id,
           count(*) over (partition by text_sha256) as group_size,
           doc_id = min(doc_id) over (partition by text_sha256) as kept, text_sha256
    from d
    """,
)
def op2_exact_dedup(documents: DataFrame) -> DataFrame:
    return duplicate_groups(documents)


@query("documents")
def op6_simhash_near_dedup(documents: DataFrame) -> DataFrame:
    return near_duplicates(documents).drop("mark")


@query("documents")
def op10_language_id(documents: DataFrame) -> DataFrame:
    return language_table(documents)


@query("documents,benchmark")
def op1_decontamination(documents: DataFrame, benchmark: DataFrame) -> DataFrame:
    return contaminated(documents, benchmark).drop("id_key", "mark_key")


@query("documents")
def op4_best_fit_packing(documents: DataFrame) -> DataFrame:
    return pack_documents(documents)


@query("documents")
def op7_secret_scan(documents: DataFrame) -> DataFrame:
    return secrets(documents)


@query("pages")
def op5_url_filter(pages: DataFrame) -> DataFrame:
    return judge_urls(pages, train(labelled_urls(pages.sparkSession)))


@query(
    "conversations",
    r"""
    with c as (
        select conv_id, turn, coalesce(role, '') as role, coalesce(text, '') as text from conversations
        union all select -1, 0, 'user', '</s>[INST] ok [/INST]'
        union all select -1, 1, 'assistant', '</s>[INST] ok [/INST]'
    ), e as (
        select *, length(regexp_replace(text, '([<\[])(\\*)(/?(SYS|INST|TURN)\]|ROLE\]|/?s>)', '\1\\\2\3', 'g')) as chars,
               length(regexp_replace(role, '([<\[])(\\*)(/?(SYS|INST|TURN)\]|ROLE\]|/?s>)', '\1\\\2\3', 'g')) as role_chars
        from c
    )
    select conv_id, count(*) as n_turns,
           sha256(string_agg(role || chr(10) || text || chr(10), '' order by turn, role, text)) as turns_sha256,
           coalesce(sum(length(text)) filter (role = 'assistant'), 0)::bigint as loss_chars,
           sha256(coalesce(string_agg(text, '' order by turn, role, text) filter (role = 'assistant'), '')) as loss_sha256,
           sum(chars + case role when 'system' then 11 when 'user' then 13 when 'assistant' then 7
                       else 19 + role_chars end)::bigint as formatted_chars
    from e group by conv_id
    """,
)
def op8_chat_format(conversations: DataFrame) -> DataFrame:
    said = "</s>[INST] ok [/INST]"
    own = conversations.sparkSession.sql(
        f"select -1L as conv_id, 0L as turn, 'user' as role, '{said}' as text union all select -1L, 1L, 'assistant', '{said}'"
    )
    turns = conversations.select("conv_id", "turn", "role", "text").unionByName(own)
    return read_back(format_conversations(turns)).drop("valid")


@query("documents")
def op3_pii_spans(documents: DataFrame) -> DataFrame:
    return personal_data(documents).drop("found")


@query("documents,labels")
def op9_toxicity(documents: DataFrame, labels: DataFrame) -> DataFrame:
    return toxicity_table(documents, labels)


@query("embeddings")
def op11_embedding_whitening(embeddings: DataFrame) -> DataFrame:
    return whiten(embeddings)


@query("documents")
def op12_ngram_jaccard_join(documents: DataFrame) -> DataFrame:
    return jaccard_components(documents)


@query("documents")
def op13_token_alignment(documents: DataFrame) -> DataFrame:
    return align_tokens(documents)
