import zlib

import numpy as np

import corpus_pipeline
from test_decontamination import dc
from test_fertility import base
from test_forest import brute_force
from test_replication import drawn
from tidemart.llm import queries, replication, vocab
from tidemart.llm.fertility import DEFAULT_BANDS
from test_fertility import fertility
from tidemart.llm.fertility import script_of, scripts_in

SF = "/root/testdata/sf0.001"


def test_run_equals_brute_force(spark):
    docs = {r["doc_id"]: r for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}

    def fits(text, lang):
        per_token, share, spread = fertility(text)
        band = DEFAULT_BANDS.of(lang, script_of(scripts_in(text)))
        return band.low <= per_token <= band.high and share <= band.byte_share and spread >= band.entropy

    left = {key: r for key, r in docs.items() if not base(r["text"])[-1] and fits(r["text"], r["lang"])}
    classes = brute_force([(key, r["text"]) for key, r in left.items()])
    left = {key: r for key, r in left.items() if classes[key][0] == key}
    items = [" ".join(dc.words_of(r["text"])) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    left = {key: r for key, r in left.items() if not any(f" {item} " in f" {' '.join(dc.words_of(r['text']))} " for item in items)}
    mass = {}
    for r in left.values():
        mass[r["source"]] = mass.get(r["source"], 0) + len(r["text"])
    roots = {source: n ** (1 / corpus_pipeline.MIX_TEMPERATURE) for source, n in mass.items()}
    rate = {source: roots[source] / sum(roots.values()) * sum(mass.values()) / n for source, n in mass.items()}
    encoder = vocab.byte_encoder(vocab.vocabulary_path(vocab.BYTE_BPE))
    expected, start = [], 0
    for key in sorted(left):
        ids = np.append(np.frombuffer(encoder.whole(left[key]["text"]), "<u4"), np.uint32(2)).astype("<u4")
        for _ in range(drawn(rate[left[key]["source"]], corpus_pipeline.MIX_SEED, key)):
            expected.append((key, start, len(ids), zlib.crc32(ids.tobytes())))
            start += len(ids)
    assert sorted(map(tuple, corpus_pipeline.run(spark, SF).collect())) == expected
    assert len(expected) > 20


def test_stages_return_documents(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    assert [name for name, _ in corpus_pipeline.STAGES] == ["quality_rules", "near_copies", "benchmark_items", "mixing", "token_output"]
    for _, stage in corpus_pipeline.STAGES[:-1]:
        assert stage(spark, docs, SF).columns == docs.columns
        assert stage(spark, docs.limit(0), SF).collect() == []


def test_every_operator_has_its_query():
    assert {int(name[2:].split("_")[0]) for name in queries.QUERIES} == set(range(1, 14))
    assert set(queries.SQL) == {"op1_perspective_rotation", "op7_poisson_replication", "op11_spelling_variants", "op13_warc_index"}
    assert (corpus_pipeline.MIX_SEED, corpus_pipeline.MIX_TEMPERATURE) == (queries.MIX_SEED, queries.MIX_TEMPERATURE)
    assert replication.PART_RATE <= 16
