"""Registered queries of the numbered operators, with check SQL where SQL can express them."""

from __future__ import annotations

from collections.abc import Callable, Iterator
from zlib import crc32

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from roadgauge.llm import (
    bpe, common, context_tree, exact_dedup, fingerprints, lang_id, packing, periodic_runs, pii, simhash, substring_dedup,
    token_counts, toxicity, vector_codes,
)
from roadgauge.session import stage

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
CHECK_SQL: dict[str, str] = {}


#: A production run takes its key from a secret store; this one makes the registered query repeatable.
PII_KEY = "registered-query-key"


def tokenizer_path(name: str) -> str:
    """Place of a public tokenizer's file."""
    import public_tokenizers

    return public_tokenizers.path(name)


def query(name: str, sql: str | None = None):
    def register(function: Callable[[DataFrame], DataFrame]):
        def run(spark: SparkSession, folder: str) -> DataFrame:
            return function(common.table(spark, folder, "documents"))

        QUERIES[name] = run
        if sql is not None:
            CHECK_SQL[name] = sql
        return function

    return register


@query("op1_substring_dedup", r"""
with words as (
    select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as w from documents
), starts as (
    select doc_id, unnest(range(1, len(w) - 11)) as s, w from words where len(w) >= 13
), windows as (
    select doc_id, s, sha256(array_to_string(w[s:s + 12], ' ')) as h from starts
), firsts as (
    select h, min(doc_id) as first_id from windows group by h
), gone as (
    select distinct doc_id, unnest(range(s, s + 13)) as p from windows join firsts using (h) where first_id < doc_id
), listed as (
    select doc_id, list(p) as p from gone group by doc_id
)
select words.doc_id, cast(len(w) as bigint) as n_words, cast(coalesce(len(p), 0) as bigint) as n_removed,
    sha256(coalesce(array_to_string(
        case when p is null then w
            else list_transform(list_filter(range(1, len(w) + 1), lambda i: not list_contains(p, i)), lambda i: w[i]) end,
        ' '), '')) as kept_sha256
from words left join listed using (doc_id)
""")
def op1(documents: DataFrame) -> DataFrame:
    return substring_dedup.deduplicate(documents).select(
        "doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


@query("op2_language_id")
def op2(documents: DataFrame) -> DataFrame:
    path, held_out = tokenizer_path("piece_bpe_32k.model"), common.fold_of("doc_id", 3) == 1
    languages, table = lang_id.train(documents.where(~held_out), path)
    found = lang_id.predict(documents, path, languages, table)
    return found.select("doc_id", held_out.alias("held_out"), "lang_pred", "score")


@query("op3_exact_dedup", """
with texts as (
    select doc_id, sha256(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')) as h
    from documents
)
select doc_id, max(doc_id) over same as keep_id, count(*) over same as group_size,
    doc_id = max(doc_id) over same as kept, h as text_sha256
from texts window same as (partition by h)
""")
def op3(documents: DataFrame) -> DataFrame:
    return exact_dedup.deduplicate(documents, exact_dedup.new_index(documents.sparkSession))


@query("op4_edit_fingerprints")
def op4(documents: DataFrame) -> DataFrame:
    made = fingerprints.fingerprints(documents).select(
        "doc_id", "n_chars", F.sha2("edited_text", 256).alias("edited_sha256"), "fingerprint", "edited_fingerprint",
        "near_edited", "near_next")
    return fingerprints.near_components(stage(made, "prints")).select(*made.columns, "component_id")


@query("op5_pii_pseudonyms")
def op5(documents: DataFrame) -> DataFrame:
    return pii.protect(documents.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), PII_KEY)


@query("op6_bpe_chunks")
def op6(documents: DataFrame) -> DataFrame:
    return bpe.encode(documents, tokenizer_path("word_bpe_49k.json")).select(
        "doc_id", "n_tokens", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))


@query("op7_harmonic_packing")
def op7(documents: DataFrame) -> DataFrame:
    return packing.pack(documents, tokenizer_path("word_bpe_49k.json")).select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


@query("op8_simhash_bk_trees")
def op8(documents: DataFrame) -> DataFrame:
    return simhash.near_duplicates(documents).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query("op10_token_counts")
def op10(documents: DataFrame) -> DataFrame:
    return token_counts.count_tokens(documents, tokenizer_path("piece_bpe_32k.model"))


def toxicity_model(documents: DataFrame, labels: DataFrame) -> toxicity.Model:
    """Fitted to the labels whose documents are not held out."""
    return toxicity.train(documents, labels.where(common.fold_of("doc_id", 5) != 0))


def op9(spark: SparkSession, folder: str) -> DataFrame:
    documents = common.table(spark, folder, "documents")
    model = toxicity_model(documents, common.table(spark, folder, "labels"))
    return toxicity.score(documents, model).select(
        "doc_id", (common.fold_of("doc_id", 5) == 0).alias("held_out"), "score", "predicted")


QUERIES["op9_toxicity"] = op9


def vector_code_sql(rounds: int = vector_codes.ROUNDS) -> str:
    """The rounds written out one after the other, on exact integers."""
    width = "(len(v) // 8)"
    steps = [f"""
with whole as (
    select vec_id, label, list_transform(embedding, lambda x: cast(floor(4096 * cast(x as double)) as hugeint)) as v
    from embeddings
    where embedding is not null and len(list_filter(embedding, lambda x: x is null or not isfinite(x))) = 0
), parts as (
    select vec_id, label, p, v[p * {width} + 1:(p + 1) * {width}] as v from whole, (select unnest(range(8)) as p)
), book0 as (
    select p, row_number() over (partition by p order by vec_id) - 1 as e, v as c
    from parts where vec_id in (select vec_id from whole order by vec_id limit 16)
)"""]
    assign = """select vec_id, any_value(label) as label, p, any_value(v) as v, min(struct_pack(
        d := list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))), e := e)) as best
    from parts join book{0} using (p) group by vec_id, p"""
    for i in range(rounds):
        steps.append(f"near{i} as ({assign.format(i)})")
        steps.append(f"""sums{i} as (
    select p, e, list(m order by i) as c from (
        select p, e, i, cast((s - ((s % n) + n) % n) // n as hugeint) as m from (
            select p, best.e as e, i, cast(sum(x) as hugeint) as s, count(*) as n
            from (select p, best, unnest(v) as x, unnest(range(len(v))) as i from near{i}) group by p, best.e, i))
    group by p, e
), book{i + 1} as (select p, e, coalesce(n.c, o.c) as c from book{i} o left join sums{i} n using (p, e))""")
    steps.append(f"near{rounds} as ({assign.format(rounds)})")
    steps.append(f"""coded as (
    select vec_id, any_value(label) as label, string_agg(printf('%02x', best.e), '' order by p) as code,
        cast(sum(best.d) as bigint) as error
    from near{rounds} group by vec_id
), books as (
    select sha256(string_agg(cast(x as varchar), ',' order by p, e, i)) as codebooks_sha256
    from (select p, e, unnest(c) as x, unnest(range(len(c))) as i from book{rounds})
)
select vec_id, code, error, cast(sum(error) over (partition by label) as bigint) as label_error, codebooks_sha256
from coded, books""")
    return ",\n".join(steps)


def op11(spark: SparkSession, folder: str) -> DataFrame:
    coded, books = vector_codes.compress(common.table(spark, folder, "embeddings"))
    return coded.select("vec_id", "code", "error", "label_error", F.lit(books.sha256()).alias("codebooks_sha256"))


QUERIES["op11_vector_codes"] = op11
CHECK_SQL["op11_vector_codes"] = vector_code_sql()


@query("op12_context_tree_scores")
def op12(documents: DataFrame) -> DataFrame:
    return context_tree.score_texts(documents, common.fold_of("doc_id", 7) == 2)


def with_periodic_tails(documents: DataFrame) -> DataFrame:
    """doc_id and text; one document in ten (by its id) has its words repeat from some word on. Rows without id stay as they are."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, texts = batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.binary()).to_pylist()
            for i, (doc_id, text) in enumerate(zip(ids, texts)):
                h = 1 if doc_id is None else crc32(str(doc_id).encode())
                words = text.split() if text and h % 10 == 0 else []
                if words:
                    n, g = len(words), h // 10
                    a = g % n
                    p = 1 + (n - a) // (3 + g % 8)
                    texts[i] = b" ".join(words[:a] + [words[a + k % p] for k in range(n - a)])
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(texts, pa.binary()).cast(pa.string())], ["doc_id", "text"])

    return common.id_and_text(documents).mapInArrow(run, "doc_id long, text string")


@query("op13_periodic_runs")
def op13(documents: DataFrame) -> DataFrame:
    found = periodic_runs.find_runs(with_periodic_tails(documents))
    longest = F.element_at(F.filter("runs", lambda r: r["length"] == F.array_max(F.transform("runs", lambda x: x["length"]))), 1)
    lines = F.transform("runs", lambda r: F.concat(F.concat_ws(",", r["start"], r["length"], r["period"]), F.lit("\n")))
    top = found.withColumn("top", F.when(F.size("runs") > 0, longest))
    return top.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), "top.start", "top.length", "top.period",
        F.floor(1000 * F.col("top.length") / F.col("top.period")).cast("long").alias("exponent_milli"),
        F.sha2(F.array_join(lines, "").cast("binary"), 256).alias("runs_sha256"),
        F.sha2(F.col("collapsed_text").cast("binary"), 256).alias("collapsed_sha256"))
