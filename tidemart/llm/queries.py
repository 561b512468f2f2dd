"""The registered query of each operator, and its SQL twin where SQL can say it."""

from __future__ import annotations

import zlib
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemart.llm import alignment, chat, decontamination, disclosure, fertility, forest, lineblocks, replication, rollups, spelling, token_files, toxicity, vocab, warc
from tidemart.session import materialize, new_shared_path

#: The mix of the registered query and of the pipeline: shares as square roots of the sources' characters.
MIX_SEED, MIX_TEMPERATURE = 17, 2.0

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(run: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op1_perspective_rotation(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.perspectives(table(spark, sf_dir, "conversations"))


SQL["op1_perspective_rotation"] = f"""
with rows as (
    select conv_id, turn, coalesce(role, '{chat.UNNAMED}') as speaker, coalesce(role, '') = 'system' as is_system,
        replace(coalesce(text, ''), '<|', '< |') as content
    from conversations
), placed as (
    select *, row_number() over (partition by conv_id order by turn nulls last, speaker, content) as position from rows
), speakers as (
    select distinct conv_id, speaker as perspective from rows where not is_system
), shown as (
    select p.*, s.perspective, not is_system and speaker = s.perspective as train,
        case when is_system then speaker when speaker = s.perspective then 'assistant' else 'user' end as shown_role,
        case when not is_system and speaker <> s.perspective then replace(speaker, '<|', '< |') end as name
    from placed p join speakers s on p.conv_id is not distinct from s.conv_id
), segments as (
    select *, '<|' || shown_role || coalesce(' name=' || name, '') || '|>' || chr(10) || content || '<|end|>' || chr(10) as rendered from shown
), lines as (
    select *, sum(length(rendered)) over (partition by conv_id, perspective order by position) as upto from segments
)
select conv_id, perspective, position::bigint as position, turn, shown_role as role, name, content, rendered, train,
    (upto - length(rendered))::bigint as start, upto::bigint as "end",
    case when train then (upto - length(rendered) + {len("<|assistant|>") + 1})::bigint end as mask_start,
    case when train then upto::bigint end as mask_end
from lines
"""


@query
def op2_compression_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    held_out = F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit(""))) % 4 == 2
    classifier = toxicity.fit(*toxicity.labelled_sample(docs, table(spark, sf_dir, "labels").filter(~held_out)))
    return toxicity.score_documents(docs.withColumn("held_out", held_out), classifier).drop("text")


@query
def op3_disclosing_terms(spark: SparkSession, sf_dir: str) -> DataFrame:
    return disclosure.span_report(table(spark, sf_dir, "documents"))


@query
def op4_tokeniser_fertility(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return fertility.judge_documents(docs).drop("text", "lang")


@query
def op5_line_blocks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineblocks.extract_pages(table(spark, sf_dir, "pages").select("page_id", "url", "html"))


@query
def op6_token_rollups(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Totals after four batches over all documents: all are inserted; those of low quality are deleted; the others are
    revised to count the id that ends a document; the deletion comes a second time and must not count."""
    docs = table(spark, sf_dir, "documents").select("doc_id", "source", "lang", "text")
    low = table(spark, sf_dir, "labels").filter("quality = 0").select("doc_id", F.lit(True).alias("low")).distinct()
    counted = docs.select(
        "doc_id", "source", "lang", F.lit(vocab.BYTE_BPE_RANKS).alias("tokenizer"), rollups.token_count(F.col("text")).alias("n_tokens"),
        F.coalesce(F.length("text"), F.lit(0)).cast("long").alias("n_chars"),
    )
    counts = materialize(counted, "counts").join(low, "doc_id", "left")
    before = {"old_tokens": F.lit(None).cast("long"), "old_chars": F.lit(None).cast("long")}
    deleted = counts.filter("low").withColumns({"change": F.lit("delete"), **before})
    revised = counts.filter("low is null").withColumns(
        {"change": F.lit("revise"), "old_tokens": F.col("n_tokens"), "old_chars": F.col("n_chars"), "n_tokens": F.col("n_tokens") + 1}
    )
    store = rollups.Rollup(spark, new_shared_path(spark, "rollup"))
    store.apply("load", counts.withColumns({"change": F.lit("insert"), **before}))
    store.apply("low quality", deleted)
    store.apply("end id", revised)
    store.apply("low quality", deleted)
    return store.totals()


@query
def op7_poisson_replication(spark: SparkSession, sf_dir: str) -> DataFrame:
    return replication.mix(table(spark, sf_dir, "documents"), seed=MIX_SEED, temperature=MIX_TEMPERATURE)


SQL["op7_poisson_replication"] = f"""
with recursive sums as (
    select source, sum(coalesce(length(text), 0)) as mass from documents group by source
), shares as (
    select source, mass, pow(mass::double, 1.0 / {MIX_TEMPERATURE}) as raw from sums
), rates as (
    select source, case when mass > 0 then raw / (select sum(raw) from shares) * (select sum(mass) from shares)::double / mass else 0.0 end as rate
    from shares
), parts as (
    select source, rate, greatest(ceil(rate / {replication.PART_RATE}), 1)::int as n from rates
), tables as (
    select source, n, rate / n as mean, 0 as k, exp(-(rate / n)) as p, exp(-(rate / n)) as below from parts
    union all
    select source, n, mean, k + 1, p * mean / (k + 1), below + p * mean / (k + 1) from tables where k < {replication.TABLE_LENGTH}
), drawn as (
    select d.doc_id, d.source, t.below, part,
        (('0x' || substr(md5('{MIX_SEED}:' || coalesce(d.doc_id::varchar, '') || ':' || part), 1, 13))::bigint + 0.5) / {1 << 52}.0 as u
    from documents d join parts p on d.source is not distinct from p.source, unnest(range(1, p.n + 1)) as numbers(part)
        join tables t on t.source is not distinct from d.source
), counts as (
    select doc_id, source, count(*) filter (where below < u) as copies from drawn group by doc_id, source
)
select d.*, copy::int as copy
from documents d join counts c on c.doc_id is not distinct from d.doc_id and c.source is not distinct from d.source,
    unnest(range(1, c.copies + 1)) as numbers(copy)
"""


@query
def op8_bm25_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontamination.contaminated(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


@query
def op9_minhash_forest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return forest.classes(table(spark, sf_dir, "documents"))


@query
def op10_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest = token_files.write_token_files(table(spark, sf_dir, "documents"), new_shared_path(spark, "tokens"))
    return token_files.read_token_files(spark, manifest, ids=False)


def planted_typo(key: str, word: str) -> str:
    """One letter less in the occurrences that a hash of id and word picks."""
    hashed = zlib.crc32(f"{key}:{word}".encode())
    at = hashed % len(word)
    return word if hashed % 97 else word[:at] + word[at + 1 :]


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.variants(spelling.word_counts(table(spark, sf_dir, "documents"), altered=planted_typo))


SQL["op11_spelling_variants"] = """
with recursive crc_table as (
    select list(list_reduce(list_prepend(byte, range(8)), lambda c, k: case when c & 1 = 1 then xor(c >> 1, 3988292384) else c >> 1 end) order by byte) as steps
    from unnest(range(256)) as bytes(byte)
), runs as (
    select coalesce(doc_id::varchar, '') as doc,
        translate(unnest(regexp_extract_all(coalesce(text, ''), '[A-Za-z\\x{C0}-\\x{FF}]{5,}')), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') as run
    from documents
), hexed as (
    select run, count(*) as n, hex(encode(doc || ':' || run)) as hexed from runs group by doc, run
), hashed as (
    select run, n, xor(list_reduce(
        list_prepend(4294967295::bigint, list_transform(range(length(hexed) // 2), lambda i: ('0x' || substr(hexed, 2 * i + 1, 2))::bigint)),
        lambda acc, byte: xor(acc >> 8, steps[(xor(acc, byte) & 255) + 1])), 4294967295::bigint) as h
    from hexed, crc_table
), altered as (
    select n, case when h % 97 = 0 then substr(run, 1, (h % length(run))::bigint) || substr(run, (h % length(run))::bigint + 2) else run end as word from hashed
), words as (
    select word, sum(n)::bigint as n from altered where length(word) >= 5 group by word having sum(n) >= 3
), cuts as (
    select word, n, i, substr(word, 1, i - 1) as a, substr(word, i + 1) as b from words, unnest(range(1, length(word) + 1)) as places(i)
), near as (
    select x.word, y.word as other, y.n as other_n from cuts x join cuts y on x.i = y.i and x.a = y.a and x.b = y.b and x.word <> y.word
    union select x.word, y.word, y.n from cuts x join words y on x.a || x.b = y.word
    union select y.word, x.word, x.n from cuts x join words y on x.a || x.b = y.word
), ranked as (
    select *, count(*) over (partition by word) as n_near, row_number() over (partition by word order by other_n desc, encode(other)) as place from near
), formed as (
    select w.word, w.n, coalesce(r.n_near, 0) as n_near, case when r.other_n >= 2 * w.n then r.other end as form,
        case when r.other_n >= 2 * w.n then r.other_n end as form_n
    from words w left join ranked r on w.word = r.word and r.place = 1
), climbed as (
    select word, word as root, 0 as steps from formed
    union all select c.word, f.form, c.steps + 1 from climbed c join formed f on c.root = f.word where f.form is not null
), last as (
    select word, arg_max(root, steps) as root from climbed group by word
)
select f.word, f.form, l.root, f.n, f.n_near, f.form_n from formed f join last l on f.word = l.word
"""


@query
def op12_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    return alignment.align_documents(table(spark, sf_dir, "documents"))


@query
def op13_warc_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All records of the archive of all pages, through its index."""
    pages = table(spark, sf_dir, "pages")
    index = warc.write_archive(pages, new_shared_path(spark, "warc"))
    kind = pages.schema["page_id"].dataType
    records = warc.read_records(index, payloads=False)
    return records.select(F.col("key").cast(kind).alias("page_id"), "payload_bytes", "payload_digest", "record_type", F.col("refers_to").cast(kind).alias("refers_to"))


SQL["op13_warc_index"] = f"""
with rows as (
    select page_id, octet_length(encode(coalesce(html, ''))) as payload_bytes, sha256(coalesce(html, '')) as payload_digest from pages
), firsts as (
    select payload_digest, min(page_id) as first, count(*) as n from rows where payload_bytes >= {warc.LEAST_BYTES} group by payload_digest
)
select page_id, payload_bytes, r.payload_digest, case when n > 1 and page_id is distinct from first and first is not null then 'revisit' else 'response' end as record_type,
    case when n > 1 and page_id is distinct from first then first end as refers_to
from rows r left join firsts f on r.payload_digest = f.payload_digest
"""
