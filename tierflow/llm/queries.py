"""The operators as queries over the test tables, and the SQL for those that SQL can express."""

from __future__ import annotations

import string
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from . import (
    decontaminate,
    exact_dedup,
    extraction,
    licenses,
    lm,
    merkle,
    near_dedup,
    nearest,
    packing,
    search,
    secrets,
    sharding,
    toxicity,
)
from .common import read_table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("byte_bpe_50k.json")


@query
def op1_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.duplicate_groups(read_table(spark, sf_dir, "documents"))


SQL["op1_exact_dedup"] = r"""
    with texts as (
        select doc_id, length(coalesce(text, '')) as chars,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') as norm
        from documents
    )
    select doc_id,
           first_value(doc_id) over best as keep_id,
           count(*) over (partition by norm) as group_size,
           row_number() over best = 1 as kept,
           sha256(norm) as text_sha256
    from texts
    window best as (partition by norm order by chars desc, doc_id nulls last)
"""


@query
def op2_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.shards(read_table(spark, sf_dir, "documents"), n_shards=8, law="bytes")


@query
def op7_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    pieces = packing.packed(read_table(spark, sf_dir, "documents"), tokenizer_path())
    return pieces.select(
        "doc_id",
        "start",
        "length",
        F.crc32("ids").alias("ids_crc32"),
        "doc_tokens",
        "sequence_id",
        "offset",
    )


@query
def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents")
    return toxicity.score(docs, toxicity.fit(docs, read_table(spark, sf_dir, "labels")))


@query
def op5_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_dedup.near_duplicates(read_table(spark, sf_dir, "documents"))


@query
def op6_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


@query
def op4_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    return secrets.secret_spans(read_table(spark, sf_dir, "documents"))


@query
def op3_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extraction.main_texts(read_table(spark, sf_dir, "pages"))


@query
def op9_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_matches(read_table(spark, sf_dir, "documents"))


@query
def op8_lm_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    tokens = lm.tokens(read_table(spark, sf_dir, "documents"), tokenizer_path())
    model, rest = lm.fit(tokens, tokenizer_path())
    return lm.score(tokens, model, rest, tokenizer_path())


MANIFEST_FIELDS = ("doc_id", "source", "lang", "n_chars", "text")


@query
def op12_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Proofs of all documents, and what follows from them for rows of which a fifth were tampered with."""
    docs = read_table(spark, sf_dir, "documents")
    lowered = F.translate("text", string.ascii_uppercase, string.ascii_lowercase)
    others = [F.col(c) for c in MANIFEST_FIELDS if c != "text"]
    chosen = F.crc32(F.col("doc_id").cast("string")) % 5 == 0
    offered = F.when(chosen, merkle.leaf_digest([*others, lowered]))
    proofs = merkle.manifest(docs, MANIFEST_FIELDS, carry={"offered": offered})
    folded = merkle.folded(F.coalesce("offered", "leaf"), F.col("path"))
    return proofs.select(
        "doc_id",
        "leaf",
        "subroot",
        "root",
        merkle.siblings_digest(F.col("path")).alias("proof_sha256"),
        folded.alias("folded_root"),
    ).withColumn("verified", F.col("folded_root") == F.col("root"))


def _manifest_sql(levels: int = 6, top_levels: int = 4) -> str:
    """The trees level by level, each level a grouping; enough for 16 ** levels rows a source, 16 ** top_levels sources."""
    fields = {c: f"cast({c} as varchar)" for c in MANIFEST_FIELDS}

    def leaf(values: dict[str, str]) -> str:
        return "sha256(" + " || ".join(f"coalesce(strlen({v}) || ':' || {v}, '-')" for v in values.values()) + ")"

    # the polynomial of CRC-32, bit by bit, over the decimal digits
    bit = "lambda c, i: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end"
    digits = "list_transform(string_split(cast(doc_id as varchar), ''), lambda d: cast(ascii(d) as bigint))"
    byte = f"lambda crc, d: list_reduce(cast(range(8) as bigint[]), {bit}, xor(crc, d))"
    crc = f"xor(list_reduce({digits}, {byte}, cast(4294967295 as bigint)), 4294967295)"
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    parts = [
        f"""rows as (
        select doc_id, source, {leaf(fields)} as leaf,
               case when {crc} % 5 = 0 then {leaf(fields | {"text": lowered})} else {leaf(fields)} end as offered
        from documents)""",
        """l0 as (
        select *, leaf as node, offered as folded, '' as siblings,
               row_number() over (partition by source order by doc_id nulls first, leaf) - 1 as place,
               row_number() over () as id
        from rows)""",
    ]

    def level(name: str, before: str, group: str) -> str:
        """One level up for every row: the nodes of its run, what is left and right of its own."""
        return f"""{name}_nodes as (select distinct {group}, place, node from {before}),
        {name}_runs as (
        select {group} as g, place // 16 as run, list(node order by place) as nodes,
               sum(count(*)) over (partition by {group}) as n
        from {name}_nodes group by {group}, place // 16),
        {name} as (
        select b.* exclude (node, folded, siblings, place),
               case when n = 1 then node else sha256(list_aggregate(nodes, 'string_agg', '')) end as node,
               case when n = 1 then folded else sha256(
                   coalesce(list_aggregate(nodes[1 : place % 16], 'string_agg', ''), '') || folded
                   || coalesce(list_aggregate(nodes[place % 16 + 2 : 16], 'string_agg', ''), '')) end as folded,
               case when n = 1 then siblings else siblings
                   || coalesce(list_aggregate(nodes[1 : place % 16], 'string_agg', ''), '')
                   || coalesce(list_aggregate(nodes[place % 16 + 2 : 16], 'string_agg', ''), '') end as siblings,
               place // 16 as place
        from {before} b join {name}_runs on g is not distinct from {group} and run = place // 16)"""

    parts += [level(f"l{i + 1}", f"l{i}", "source") for i in range(levels)]
    parts.append(
        f"""t0 as (
        select * exclude (place), node as subroot, 0 as one,
               dense_rank() over (order by source nulls first) - 1 as place
        from l{levels})"""
    )
    parts += [level(f"t{i + 1}", f"t{i}", "one") for i in range(top_levels)]
    return f"""
    with {", ".join(parts)}
    select doc_id, leaf, subroot, node as root, sha256(siblings) as proof_sha256, folded as folded_root,
           folded = node as verified
    from t{top_levels}
    """


SQL["op12_merkle_manifest"] = _manifest_sql()


@query
def op11_ranked_search(spark: SparkSession, sf_dir: str) -> DataFrame:
    return search.ranked_documents(read_table(spark, sf_dir, "documents"), read_table(spark, sf_dir, "benchmark"))


def _terms_sql(table: str, key: str) -> str:
    lowered = f"translate(text, '{string.ascii_uppercase}', '{string.ascii_lowercase}')"
    return f"select {key}, unnest(regexp_extract_all({lowered}, '{search.TERM}')) as term from {table}"


SQL["op11_ranked_search"] = f"""
    with numbered as (select row_number() over () as r, doc_id, text from documents),
    terms as ({_terms_sql("numbered", "r, doc_id")}),
    asked as (select distinct item_id, term from ({_terms_sql("benchmark", "item_id")}) z),
    lengths as (select r, any_value(doc_id) as doc_id, count(*) as n from terms group by r),
    totals as (select count(*) as docs, cast(sum(n) as bigint) as all_terms from lengths),
    found as (select r, term, count(*) as tf from terms where term in (select term from asked) group by r, term),
    weights as (
        select term, cast(floor(1000 * ln((2 * any_value(docs) + 2) / (2 * count(*) + 1))) as bigint) as w
        from found, totals group by term
    ),
    scored as (
        select item_id, r, any_value(doc_id) as doc_id,
               cast(sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * docs) // all_terms)))) as bigint)
               as score
        from found join weights using (term) join asked using (term) join lengths using (r), totals
        group by item_id, r
    ),
    ranked as (
        select *, row_number() over (partition by item_id order by score desc, doc_id nulls last) as rank
        from scored where score > 0
    )
    select item_id, cast(rank as integer) as rank, doc_id, score from ranked where rank <= 10
"""


@query
def op13_nearest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return nearest.nearest(read_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 20 == 0)
